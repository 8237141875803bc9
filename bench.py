"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is executed
in full through the no-op sink (no driver collection); the reported time is
the median of ``$BENCH_REPEATS`` warm runs.  Work done once per corpus is timed
once, cold: vocabulary learning (``bpe_learn_32``, iterative), the prepared
word-id sequence table (``word_seqs_build``) and its vocabulary size
(``word_vocab_size``).  Progress goes to stderr.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wordloom.plans import common, registry  # noqa: E402
from wordloom.session import build_session  # noqa: E402

HEADLINE = ["word_counts", "train_eval_split", "sample_n", "encode_tokens", "decode_tokens", "ngram_counts", "rolling_loss", "pad_batch", "token_nll", "eval_loss"]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(f"local[{cpus}]", partitions=int(cpus) * 2)
    timings: dict[str, float] = {}
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM start-up, not any operator

    once = [
        ("bpe_learn_32", lambda: common.learned_tokenizer(spark, sf_dir, common.BPE_MERGES)),
        ("bpe_learn_4096", lambda: common.learned_tokenizer(spark, sf_dir)),
        ("word_seqs_build", lambda: common.word_seq_table(spark, sf_dir)),
        ("word_vocab_size", lambda: common.word_vocab_size(spark, sf_dir)),
    ]
    for name, build in once:
        t0 = time.time()
        build()
        timings[name] = round(time.time() - t0, 3)
        print(name, timings[name], file=sys.stderr, flush=True)

    for name in HEADLINE:
        fn = registry.Q[name]
        run_noop(fn(spark, sf_dir))  # warm-up
        runs = []
        for _ in range(repeats):
            t = time.time()
            run_noop(fn(spark, sf_dir))
            runs.append(time.time() - t)
        timings[name] = round(statistics.median(runs), 3)
        print(name, timings[name], file=sys.stderr, flush=True)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_total_sec",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

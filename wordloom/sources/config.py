"""Normalise model-config JSON rows to one typed struct.

Each field takes the public key if present, else the project's own key,
else the default.  A nested ``model`` object is used when there is one;
unknown keys are dropped.  (A present-but-null key gives the default here.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: (field, public key, own key, default, type)
CONFIG_FIELDS = [
    ("vocab_size", "vocab_size", "vocab_size", 4096, "int"),
    ("max_seq_len", "max_position_embeddings", "max_seq_len", 128, "int"),
    ("d_model", "hidden_size", "d_model", 384, "int"),
    ("n_layers", "num_hidden_layers", "n_layers", 6, "int"),
    ("n_heads", "num_attention_heads", "n_heads", 6, "int"),
    ("ffn_hidden", "intermediate_size", "ffn_hidden", 768, "int"),
    ("dropout", "hidden_dropout_prob", "dropout", 0.1, "double"),
    ("pad_id", "pad_token_id", "pad_id", 0, "int"),
    ("bos_id", "bos_token_id", "bos_id", 1, "int"),
    ("eos_id", "eos_token_id", "eos_id", 2, "int"),
]

_MAP = "map<string,string>"


def normalise_config_columns(json_col) -> list[Column]:
    c = F.col(json_col) if isinstance(json_col, str) else json_col
    top = F.from_json(c, _MAP)
    cfg = F.coalesce(F.from_json(top["model"], _MAP), top)
    out = []
    for name, public, own, default, typ in CONFIG_FIELDS:
        out.append(F.coalesce(cfg[public].try_cast(typ), cfg[own].try_cast(typ), F.lit(default).cast(typ)).alias(name))
    return out


def normalise_config(df: DataFrame, json_col: str = "config", keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*keep, *normalise_config_columns(json_col))


def to_public_keys(df: DataFrame) -> DataFrame:
    """Inverse rename: own field names -> public key names."""
    return df.select(*[F.col(name).alias(public) for name, public, _, _, _ in CONFIG_FIELDS])

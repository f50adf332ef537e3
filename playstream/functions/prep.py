"""Table preparation (PR-16 .. PR-23), re-aimed from per-image / pandas code
to column expressions over tables of manifest rows, score vectors and pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.index import with_index

# The category order of the reference's one-hot labels and
# the luminosity weights of its grayscale conversion.
CATEGORY_ORDER = ("ace", "two", "three", "four", "five", "six", "seven", "eight",
                  "nine", "ten", "jack", "queen", "king")
LUMA = (0.2989, 0.5870, 0.1140)


def prepare_manifest(df: DataFrame, split: str | None = "train", root: str = "") -> DataFrame:
    """PR-16: rows of one split (with None of all, in one scan, the split in a
    column ``split``), jokers dropped (any case), ``suit`` = last
    word of the label, ``category`` = card type, ``filepaths_full``."""
    out = df.filter(F.lower(F.col("labels")) != "joker")
    if split is not None:
        out = out.filter(F.col("data set") == split)
    tag = [F.col("data set").alias("split")] if split is None else []
    return out.select(
        *tag,
        "filepaths", "labels",
        F.element_at(F.split(F.col("labels"), " "), -1).alias("suit"),
        F.col("card type").alias("category"),
        F.concat_ws("/", F.lit(root.rstrip("/")), F.col("filepaths")).alias("filepaths_full")
        if root else F.col("filepaths").alias("filepaths_full"),
    )


def one_hot(df: DataFrame, col: str, values: list[str], prefix: str = "") -> DataFrame:
    """PR-17: one 0/1 column per value, in the given order. The list is the
    caller's, so the schema does not depend on the rows."""
    return df.withColumns({f"{prefix}{v}": (F.col(col) == F.lit(v)).cast("int") for v in values})


def shuffle(df: DataFrame, key: str, seed: int = 55, position: str = "position") -> DataFrame:
    """PR-18: a seeded permutation that does not depend on partitioning: each
    row's ``position`` in the order of a hash of its key and the seed (ties by
    the key, which is unique)."""
    hashed = df.withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))).cast("binary")))
    return with_index(hashed, ["_h", key], name=position).drop("_h")


def argmax_label(scores: Column, labels: list[str]) -> Column:
    """PR-19: label of the largest score; the first one wins ties."""
    pos = F.array_position(scores, F.array_max(scores))
    return F.element_at(F.array(*[F.lit(v) for v in labels]), pos.cast("int"))


def expert_columns(vec: Column | str, experts: int, outputs: int) -> list[Column]:
    """PR-20: flat (experts x outputs) vector -> columns ``expert_<e>_<o>``."""
    v = F.col(vec) if isinstance(vec, str) else vec
    return [F.get(v, e * outputs + o).alias(f"expert_{e}_{o}")
            for e in range(experts) for o in range(outputs)]


def prune_slots(df: DataFrame, vec: str, experts: list[int], outputs: int,
                out: str | None = None) -> DataFrame:
    """PR-21: zero the outputs of pruned experts (a pruned expert outputs
    zeros, as an identity-replaced expert does after its activation)."""
    elem = df.schema[vec].dataType.elementType.simpleString()
    pruned = F.array(*[F.lit(e) for e in experts]) if experts else F.array().cast("array<int>")
    zero = F.lit(0).cast(elem)
    col = F.transform(F.col(vec), lambda x, i: F.when(
        F.array_contains(pruned, F.floor(i / outputs).cast("int")), zero).otherwise(x))
    return df.withColumn(out or vec, col)


def rescale_byte(df: DataFrame, col: str, out: str = "byte",
                 by: list[str] | None = None) -> DataFrame:
    """PR-22: (x - min) / (max - min) * 255, truncated to 0..255; min and max
    over the table or per ``by`` group (a partial aggregate joined back).
    A constant input raises an error, as the reference does."""
    x = F.col(col).cast("double")
    if by:
        rng = df.groupBy(*by).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
        src = df.join(rng, by)
        lo, hi = F.col("_lo"), F.col("_hi")
    else:
        lo_v, hi_v = df.agg(F.min(x), F.max(x)).first()
        if lo_v is not None and lo_v == hi_v:
            raise ValueError("no variation: all values are the same")
        src, lo, hi = df, F.lit(lo_v).cast("double"), F.lit(hi_v).cast("double")
    scaled = F.when(hi == lo, F.raise_error(F.lit("no variation: all values are the same"))) \
              .otherwise(((x - lo) / (hi - lo) * 255.0).cast("int"))
    res = src.withColumn(out, scaled)
    return res.drop("_lo", "_hi") if by else res


def luminosity(r: Column | str, g: Column | str, b: Column | str) -> Column:
    """PR-23: weighted channel projection."""
    cols = [F.col(c) if isinstance(c, str) else c for c in (r, g, b)]
    return cols[0] * LUMA[0] + cols[1] * LUMA[1] + cols[2] * LUMA[2]

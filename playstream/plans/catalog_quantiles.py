"""Registered queries: quantiles of any column (AG-02, AG-08), one-hot labels
(PR-17) and the permutation without a sort (PR-18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import permutation as pm
from ..functions import prep
from ..operators import selection as sel
from ..operators.aggregates import quartile_values
from ..session import materialize, small_side
from ..sources import fixtures as fx
from ..sources.tables import read_table
from .catalog import episodes_sql
from .catalog_cards import MANIFEST_SQL, _prepared
from .compare import comparable
from .registry import register

PROBS = (0.25, 0.5, 0.75)


@register("ag02_exact_any_column", """WITH q AS (
  SELECT 'l_extendedprice' AS name, quantile_disc(CAST(l_extendedprice AS DOUBLE), [0.25, 0.5, 0.75]) AS q FROM lineitem
  UNION ALL SELECT 'l_partkey', quantile_disc(CAST(l_partkey AS DOUBLE), [0.25, 0.5, 0.75]) FROM lineitem
  UNION ALL SELECT 'o_totalprice', quantile_disc(CAST(o_totalprice AS DOUBLE), [0.25, 0.5, 0.75]) FROM orders
  UNION ALL SELECT 'n_chars', quantile_disc(CAST(n_chars AS DOUBLE), [0.25, 0.5, 0.75]) FROM documents)
SELECT name, round(q[1], 6) AS q1, round(q[2], 6) AS q2, round(q[3], 6) AS q3 FROM q""")
def q_ag02_exact(spark, sf_dir):
    """Exact quartiles of columns with as many values as rows: distributed
    selection, no histogram."""
    rows = [(c, *map(float, sel.exact_quantiles(read_table(spark, sf_dir, t), c, PROBS)))
            for t, c in (("lineitem", "l_extendedprice"), ("lineitem", "l_partkey"), ("orders", "o_totalprice"), ("documents", "n_chars"))]
    return comparable(spark.createDataFrame(rows, "name string, q1 double, q2 double, q3 double"))


def _rank_fits(df, x, told, p: float, error: float):
    """One row: whether the rank of ``told``, a column of ``df``, is within
    ``error`` of ``p`` among the values of ``x``."""
    n = F.count(x)
    return (F.count_if(x < told) / n <= p + error) & (F.count_if(x <= told) / n >= p - error)


@register("ag02_quartiles_sketch", f"""{episodes_sql(True)}
SELECT 'l_extendedprice' AS name, count(*) AS rows, true AS q1, true AS q2, true AS q3 FROM lineitem
UNION ALL SELECT 'n_moves', count(*), true, true, true FROM r""")
def q_ag02_sketch(spark, sf_dir):
    """Quartiles with an error of 0.01, as the reference asks for them: whether
    each one's exact rank is within that error."""
    out = None
    for name, df in (("l_extendedprice", read_table(spark, sf_dir, "lineitem").select("l_extendedprice")),
                     ("n_moves", _moves(spark, sf_dir))):
        told = quartile_values(df, name, err=0.01).scalar()
        row = df.select(F.col(name).alias("x"), told.alias("told")).agg(
            F.count(F.lit(1)).alias("rows"), *[_rank_fits(df, F.col("x"), F.get("told", F.lit(i)), p, 0.01).alias(f"q{i + 1}") for i, p in enumerate(PROBS)])
        row = row.select(F.lit(name).alias("name"), "*")
        out = row if out is None else out.unionAll(row)
    return out


def _moves(spark, sf_dir):
    from ..functions.episodes import n_moves
    return materialize(fx.train_games(spark, sf_dir).select(n_moves(fx.TRAIN_HANDS).alias("n_moves")), "moves")


@register("ag08_merged_sketches", """SELECT l_returnflag, count(*) AS rows, CAST(count(DISTINCT strftime(l_shipdate, '%Y-%m')) AS BIGINT) AS merged, p, true AS rank_fits
FROM lineitem, (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95]) AS p) GROUP BY ALL""")
def q_ag08_sketches(spark, sf_dir):
    """A KLL sketch of prices per return flag and shipping month, merged to one
    per flag: sketches merged, and whether the rank of each estimated quantile
    among the flag's prices is within the bound."""
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.col("l_extendedprice").alias("x"))
    probs = (0.05, 0.25, 0.5, 0.75, 0.95)
    chunks = materialize(sel.quantile_sketches(li, ["l_returnflag", "month"], "x"), "sketches")
    merged = sel.merge_sketches(chunks, ["l_returnflag"]).select("l_returnflag", sel.sketch_quantiles(probs=probs).alias("told"))
    counted = materialize(merged.join(chunks.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("merged")), "l_returnflag"), "merged")
    # a row of numbers per flag is sent to the prices, so that no task gets all prices of a flag
    rows = li.join(small_side(counted), "l_returnflag").groupBy("l_returnflag", "merged").agg(
        F.count(F.lit(1)).alias("rows"), *[_rank_fits(None, F.col("x"), F.get("told", F.lit(i)), p, 2 * sel.KLL_RANK_ERROR).alias(f"f{i}") for i, p in enumerate(probs)])
    each = F.array(*[F.struct(F.lit(p).alias("p"), F.col(f"f{i}").alias("rank_fits")) for i, p in enumerate(probs)])
    return comparable(rows.select("l_returnflag", "rows", "merged", F.inline(each)))


# ------------------------------------------------------------------ PR-17

def _one_hot_sql(col: str, values) -> str:
    return MANIFEST_SQL + "\nSELECT filepaths, split, " + ", ".join(f"CAST({col} = '{v}' AS INTEGER) AS \"{v}\"" for v in values) + " FROM t"


SUIT_ORDER = tuple(sorted(fx.SUITS))
LABEL_ORDER = tuple(f"{c} of {s}" for c in prep.CATEGORY_ORDER for s in SUIT_ORDER)


@register("pr17_one_hot_suit", _one_hot_sql("suit", SUIT_ORDER))
def q_pr17_suit(spark, sf_dir):
    return comparable(prep.one_hot(_prepared(spark, sf_dir), "suit", list(SUIT_ORDER)).select("filepaths", "split", *SUIT_ORDER))


@register("pr17_one_hot_labels", _one_hot_sql("labels", LABEL_ORDER))
def q_pr17_labels(spark, sf_dir):
    """One column for each of the 52 cards."""
    out = prep.one_hot(_prepared(spark, sf_dir), "labels", list(LABEL_ORDER))
    return comparable(out.select("filepaths", "split", *LABEL_ORDER))


# ------------------------------------------------------------------ PR-18

def permutation_sql(seed: int = 55, table: str = "lineitem") -> str:
    """The network in integer arithmetic: CTE ``walk`` applies it once to each
    row, and again while the place is beyond the rows."""
    l, r = "x // b", "x % b"
    for i, (k, c) in enumerate(pm.round_keys(seed)):
        half = r if i % 2 == 0 else l
        mix = f"((({half}) * {k} + {c}) % {pm.PRIME})"
        mix = f"(({mix} * {mix}) % {pm.PRIME})"
        if i % 2 == 0:
            l = f"(({l}) + {mix}) % a"
        else:
            r = f"(({r}) + {mix}) % b"
        # each round is a step of its own, so the text stays short
        yield_l, yield_r = l, r
        l, r = "l", "r"
        if i == 0:
            first = (yield_l, yield_r)
            steps = [first]
        else:
            steps.append((yield_l, yield_r))

    def network(src: str) -> str:
        sql = f"SELECT id, a, b, n, CAST({steps[0][0]} AS BIGINT) AS l, CAST({steps[0][1]} AS BIGINT) AS r FROM ({src})"
        for sl, sr in steps[1:]:
            sql = f"SELECT id, a, b, n, CAST({sl} AS BIGINT) AS l, CAST({sr} AS BIGINT) AS r FROM ({sql})"
        return f"SELECT id, a, b, n, l * b + r AS x FROM ({sql})"

    return f"""WITH RECURSIVE size AS (SELECT CAST(count(*) AS BIGINT) AS n FROM {table}),
root AS (SELECT n, (SELECT max(i) FROM range(0, CAST(sqrt(n) AS BIGINT) + 2) t(i) WHERE i * i <= n - 1) + 1 AS a FROM size),
grid AS (SELECT n, a, (n + a - 1) // a AS b FROM root),
rows AS (SELECT row_number() OVER () - 1 AS id, t.* FROM {table} t),
walk AS ({network('SELECT id, a, b, n, id AS x FROM rows, grid')}
  UNION ALL {network('SELECT * FROM walk WHERE x >= n')})"""


@register("pr18_permutation", permutation_sql() + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, x AS position FROM walk JOIN rows USING (id) WHERE x < n""")
def q_pr18_permutation(spark, sf_dir):
    """Every line with its place in a seeded permutation: a narrow projection
    over the storage order."""
    out = pm.permute(read_table(spark, sf_dir, "lineitem"), seed=55)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "position")

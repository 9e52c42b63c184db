"""Data-quality and reconciliation operators.

Every report here is one global or keyed aggregation over the data: rules are evaluated
as columns in a single pass, and the per-rule rows are unpacked from the one-row result
afterwards. Nothing is collected except the final handful of numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _unpack(agg: DataFrame, rows: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """Turn one aggregated row into several rows via ``inline(array(struct...))``."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(r, names)]) for r in rows]
    return agg.select(F.inline(F.array(*structs)))


def _funnel_rows(agg: DataFrame, table: str, total: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    rows, removed = [], F.lit(0).cast("bigint")
    for step, (rule, rejected) in enumerate(rules, start=1):
        rows_in = F.col(total) - removed
        removed = removed + F.col(rejected)
        rows.append(
            [F.lit(table), F.lit(step), F.lit(rule), rows_in, F.col(rejected), F.col(total) - removed]
        )
    return _unpack(agg, rows, ["table_name", "step", "rule", "rows_in", "rejected", "rows_out"])


def rejection_funnel(df: DataFrame, rules: Sequence[tuple[str, Column]], table: str) -> DataFrame:
    """Charge every rejected row to the first rule it fails, in one pass.

    ``rules`` are ``(name, predicate)`` pairs in order; a row passes a rule when the
    predicate is true (NULL counts as a failure, as in a ``filter``).
    """
    first_failed = None
    for step, (_, ok) in enumerate(rules, start=1):
        bad = ~F.coalesce(ok, F.lit(False))
        first_failed = F.when(bad, step) if first_failed is None else first_failed.when(bad, step)
    step_col = first_failed.otherwise(0)
    agg = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(step_col == i).alias(f"_r{i}") for i in range(1, len(rules) + 1)],
    )
    return _funnel_rows(agg, table, "_total", [(name, f"_r{i}") for i, (name, _) in enumerate(rules, 1)])


def dedupe_funnel(latest: DataFrame, versions: str, keep: Column, table: str, keep_rule: str) -> DataFrame:
    """Funnel for a keep-latest table: older versions first, then ``keep`` on the latest.

    ``latest`` is the output of ``latest_by_key(..., version_count=versions)``.
    """
    agg = latest.agg(
        F.sum(versions).alias("_total"),
        (F.sum(versions) - F.count(F.lit(1))).alias("_r1"),
        F.count_if(~F.coalesce(keep, F.lit(False))).alias("_r2"),
    )
    return _funnel_rows(agg, table, "_total", [("older_version", "_r1"), (keep_rule, "_r2")])


def join_loss(orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders in, lost for want of a product, then of a customer, and rows out.

    The dimensions are reduced to key multiplicities, so a duplicated product id fans out
    in ``orders_out`` exactly as the inner join would, without materialising the fan-out.
    """
    pk = products.groupBy("product_id").agg(F.count(F.lit(1)).alias("_np"))
    ck = customers.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_nc"))
    j = orders.select("product_id", "customer_id").join(pk, "product_id", "left").join(ck, "customer_id", "left")
    return j.agg(
        F.count(F.lit(1)).alias("orders_in"),
        F.count_if(F.col("_np").isNull()).alias("lost_at_product"),
        F.count_if(F.col("_np").isNotNull() & F.col("_nc").isNull()).alias("lost_at_customer"),
        F.coalesce(F.sum(F.col("_np") * F.col("_nc")), F.lit(0)).cast("bigint").alias("orders_out"),
    )


def control_totals(layers: Mapping[str, tuple[DataFrame, str, str, str | None]]) -> DataFrame:
    """Per layer, orders, units and revenue; ``layers[name] = (df, orders, units, revenue)``
    where ``orders`` is a column to sum or ``None`` meaning count rows."""
    parts = []
    for name, (df, orders, units, revenue) in layers.items():
        n = F.count(F.lit(1)) if orders is None else F.sum(orders)
        parts.append(
            df.agg(
                F.lit(name).alias("layer"),
                n.cast("bigint").alias("orders"),
                F.sum(units).cast("bigint").alias("units"),
                F.sum(revenue).cast("decimal(38,2)").alias("revenue"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def business_keys(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """M8: rows, distinct keys and keys that occur more than once."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        F.sum("_n").cast("bigint").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
    )


def profile(df: DataFrame, expected_types: Mapping[str, str] | None = None, exact: bool = True) -> DataFrame:
    """M7: per column, NULLs, values that fail the expected cast, distinct values, and
    min and max, taken over the cast values where a type is expected (9 < 10, not ``"10" < "9"``).

    Exact figures come from narrow (column, value) entries, which partial aggregation counts before the shuffle;
    casts, min and max then see each distinct value once. Rows are rebalanced first, so that a task holds
    the entries of one shuffle partition, however many rows one scan reads. ``exact=False`` uses HyperLogLog
    sketches instead (one pass, partial aggregation, about 5% error).
    """
    expected_types = expected_types or {}
    types = list(dict.fromkeys(f.dataType for f in df.schema))
    if exact:  # one value column a type, so that values keep their own equality and order
        value = {f.name: f"_v{types.index(f.dataType)}" for f in df.schema}
        entry = lambda f: F.struct(F.lit(f.name).alias("_c"), *[(F.col(f.name) if f.dataType == t else F.lit(None).cast(t)).alias(f"_v{i}") for i, t in enumerate(types)])
        entries = df.hint("rebalance").select(F.inline(F.array(*map(entry, df.schema))))
        df_values = entries.groupBy(*entries.columns).agg(F.count(F.lit(1)).alias("_n"))
    aggs = []
    for c in df.columns:
        own = F.when(F.col("_c") == c, F.col(value[c])) if exact else F.col(c)
        held = lambda cond: F.coalesce(F.sum(F.when((F.col("_c") == c) & cond, F.col("_n"))), F.lit(0)).cast("bigint") if exact else F.count_if(cond)  # noqa: B023, E731
        typed = own.try_cast(expected_types[c]) if c in expected_types else own
        aggs += [
            held(own.isNull()).alias(f"{c}__nulls"),
            (held(own.isNotNull() & typed.isNull()) if c in expected_types else F.lit(0).cast("bigint")).alias(f"{c}__bad"),
            (F.count(own) if exact else F.approx_count_distinct(own)).alias(f"{c}__distinct"),
            F.min(typed).cast("string").alias(f"{c}__min"),
            F.max(typed).cast("string").alias(f"{c}__max"),
        ]
    agg = (df_values if exact else df).agg(*aggs)
    rows = [
        [F.lit(c), F.col(f"{c}__nulls"), F.col(f"{c}__bad"), F.col(f"{c}__distinct"),
         F.col(f"{c}__min"), F.col(f"{c}__max")]
        for c in df.columns
    ]
    names = ["column_name", "null_count", "bad_type_count", "distinct_count", "min_value", "max_value"]
    return _unpack(agg, rows, names)


def profile_counts(df: DataFrame) -> DataFrame:
    """M7: per column rows, NULLs and distinct values, and the same of whole rows under ``*`` (the row as a value).

    Every row becomes narrow (column, value) entries that partial aggregation counts before the shuffle, so no
    wide row is repeated once a column. Values are told apart by their text (binary ones by their hex digits),
    whole rows by the SHA-256 of their JSON.
    """
    text = lambda f: F.hex(f.name) if f.dataType.typeName() == "binary" else F.when(F.col(f.name).isNotNull(), F.to_json(F.struct(f.name))) if f.dataType.typeName() in ("struct", "array", "map") else F.col(f.name).cast("string")
    whole = F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).cast("binary"), 256)
    entries = [F.struct(F.lit(f.name).alias("column_name"), text(f).alias("value")) for f in df.schema] + [F.struct(F.lit("*").alias("column_name"), whole.alias("value"))]
    per_value = df.select(F.inline(F.array(*entries))).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    nulls = F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0))
    return per_value.groupBy("column_name").agg(
        F.sum("n").cast("bigint").alias("row_count"),
        nulls.cast("bigint").alias("null_count"),
        F.count("value").alias("distinct_count"),
        F.count_if(F.col("value").isNotNull() & (F.col("n") > 1)).alias("repeated_values"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n") - 1).otherwise(0)).cast("bigint").alias("surplus_rows"),
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole-row duplicates: each distinct row occurring more than once, with its count."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


# ------------------------------------------------------------------------- constraints


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cond = None
    for c in columns:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.filter(cond)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once (PRIMARY KEY / UNIQUE)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def foreign_key_violations(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    return child.join(parent.select(*keys), list(keys), "left_anti")


def length_violations(df: DataFrame, column: str, max_len: int) -> DataFrame:
    return df.filter(F.length(column) > max_len)


def constraint_report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check with the number of violating rows (D9); all zero when clean."""
    parts = [df.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("violations")) for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass(frozen=True)
class Rule:
    """One constraint: ``kind`` is not_null, max_length (``limit``), key (PRIMARY KEY, UNIQUE) or foreign (``parent`` holds the keys)."""

    name: str
    kind: str
    table: str
    columns: tuple[str, ...]
    parent: str | None = None
    limit: int | None = None


def constraint_counts(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """Violations of every rule, zeros included, from one pass over each table.

    A row gives one narrow entry (rule, key) for each key it takes part in, as child or parent, and one for each
    NOT NULL or length rule it breaks. One shuffle by (rule, key), with partial sums in front, answers all
    rules; a second one adds up a number a rule. Counted are rows, except for ``key``: keys held
    more than once. A NULL foreign key has no parent and counts as broken.
    """
    key = lambda columns: F.to_json(F.struct(*columns))
    entry = lambda rule, k, child, parent: F.struct(F.lit(rule).alias("rule"), k.alias("key"), F.lit(child).alias("child"), F.lit(parent).alias("parent"))
    none = F.lit(None).cast("string")
    parts = []
    for table, df in tables.items():
        entries = []
        for r in rules:
            if r.table == table and r.kind == "not_null":
                entries.append(F.when(reduce(or_, [F.col(c).isNull() for c in r.columns]), entry(r.name, none, 1, 0)))
            elif r.table == table and r.kind == "max_length":
                entries.append(F.when(reduce(or_, [F.length(c) > r.limit for c in r.columns]), entry(r.name, none, 1, 0)))
            elif r.table == table:
                entries.append(entry(r.name, key(r.columns), 1, 0))
            if r.parent == table:
                entries.append(F.when(reduce(and_, [F.col(c).isNotNull() for c in r.columns]), entry(r.name, key(r.columns), 0, 1)))
        if entries:
            parts.append(df.select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull()))))
    per_key = reduce(DataFrame.unionByName, parts).groupBy("rule", "key").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    named = lambda kind: F.col("rule").isin([r.name for r in rules if r.kind == kind])
    broken = F.when(named("key"), F.when(F.col("child") > 1, 1).otherwise(0)).when(named("foreign"), F.when(F.col("parent") == 0, F.col("child")).otherwise(0)).otherwise(F.col("child"))
    counted = per_key.select(F.col("rule").alias("check_name"), broken.cast("bigint").alias("violations"))
    spark = per_key.sparkSession
    zeros = spark.createDataFrame([(r.name, 0) for r in rules], counted.schema)
    return counted.unionByName(zeros).groupBy("check_name").agg(F.sum("violations").alias("violations"))


def landed_count_check(source: DataFrame, land: Callable[[DataFrame], DataFrame], path: str, table: str) -> DataFrame:
    """D3 on the write itself: rows that left the source against rows found in the stored table.

    The source is counted by an observation on the job that lands it, so nothing is computed twice; the
    stored side is counted from the files. ``land`` is what the load does to the rows on their way.
    """
    spark = source.sparkSession
    obs = Observation(f"landed:{table}")
    land(source.observe(obs, F.count(F.lit(1)).alias("rows"))).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("loaded_rows"))
    rows = F.lit(int(obs.get["rows"])).cast("bigint")
    return stored.select(F.lit(table).alias("table_name"), rows.alias("source_rows"), "loaded_rows", (rows == F.col("loaded_rows")).alias("counts_match"))


def count_check(source: DataFrame, loaded: DataFrame, table: str) -> DataFrame:
    """D3: rows in the source and in the loaded layer, and whether they agree (one pass
    over the union of both sides)."""
    tagged = source.select(F.lit(1).alias("_side")).unionByName(loaded.select(F.lit(2).alias("_side")))
    return tagged.agg(
        F.count_if(F.col("_side") == 1).alias("source_rows"),
        F.count_if(F.col("_side") == 2).alias("loaded_rows"),
    ).select(
        F.lit(table).alias("table_name"), "source_rows", "loaded_rows",
        (F.col("source_rows") == F.col("loaded_rows")).alias("counts_match"),
    )


def control_total_mismatches(totals: DataFrame, event_rows: int, tolerance: str = "0.005") -> DataFrame:
    """D4 as a zero-row check over :func:`control_totals` output.

    Gold must equal Silver exactly; events plus event rejects must equal Gold in orders
    and units, and in revenue within ``tolerance`` for each of the ``event_rows`` published
    rows (rounding to cents moves a row by half a cent at most), however many orders they sum.
    """
    layers = ("silver", "gold", "events", "event_rejects")
    wide = totals.agg(
        *[
            F.max(F.when(F.col("layer") == layer, F.col(c))).alias(f"{layer}_{c}")
            for layer in layers
            for c in ("orders", "units", "revenue")
        ]
    )
    ev = {c: F.col(f"events_{c}") + F.coalesce(F.col(f"event_rejects_{c}"), F.lit(0)) for c in ("orders", "units", "revenue")}
    g = lambda c: F.col(f"gold_{c}")
    checks = [
        ("gold_vs_silver_orders", g("orders").eqNullSafe(F.col("silver_orders"))),
        ("gold_vs_silver_units", g("units").eqNullSafe(F.col("silver_units"))),
        ("gold_vs_silver_revenue", g("revenue").eqNullSafe(F.col("silver_revenue"))),
        ("events_vs_gold_orders", ev["orders"].eqNullSafe(g("orders"))),
        ("events_vs_gold_units", ev["units"].eqNullSafe(g("units"))),
        ("events_vs_gold_revenue",
         F.abs(ev["revenue"] - g("revenue")) <= F.lit(tolerance).cast("decimal(10,3)") * F.lit(event_rows)),
    ]
    rows = [[F.lit(name), F.coalesce(ok, F.lit(False))] for name, ok in checks]
    return _unpack(wide, rows, ["check_name", "passed"]).filter(~F.col("passed"))


def mismatches(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    exact: Sequence[str],
    tolerant: Mapping[str, str] | None = None,
    names: tuple[str, str] = ("left", "right"),
) -> DataFrame:
    """Keys on which two results disagree, with both sides' values and a reason.

    Both sides are tagged, unioned and grouped by ``keys`` in one shuffle, so NULL keys meet
    each other. ``exact`` values must be equal (NULL equals NULL); ``tolerant`` ones may be so
    far apart. A key that one side holds more than once is reported as ``repeated_key``.
    """
    tolerant = dict(tolerant or {})
    values = [*exact, *tolerant]

    def side(df: DataFrame, at: int) -> DataFrame:
        struct = F.struct(F.lit(1).alias("present"), *values)
        return df.select(*keys, *[(struct if i == at else F.lit(None)).alias(n) for i, n in enumerate(names)])

    a, b = (F.col(f"_{n}") for n in names)
    rows = side(left, 0).unionByName(side(right, 1)).groupBy(*keys).agg(
        *[F.max(n).alias(f"_{n}") for n in names],
        F.greatest(*[F.count(n) for n in names]).alias("_copies"),
    )
    close = [F.coalesce(F.abs(a[v] - b[v]) <= F.lit(by).cast("decimal(18,6)"), a[v].isNull() & b[v].isNull()) for v, by in tolerant.items()]
    same = reduce(and_, [*[a[v].eqNullSafe(b[v]) for v in exact], *close])
    reason = (
        F.when(F.col("_copies") > 1, "repeated_key")
        .when(a.isNull(), f"only_in_{names[1]}")
        .when(b.isNull(), f"only_in_{names[0]}")
        .when(~same, "values_differ")
    )
    pairs = [c[v].alias(f"{n}_{v}") for v in values for n, c in zip(names, (a, b), strict=True)]
    return rows.select(*keys, *pairs, reason.alias("reason")).where("reason IS NOT NULL")


def layer_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Rows of each table by layer (``{layer: {table: frame}}``), NULL where a layer lacks the table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(table).alias("table_name"), F.lit(layer).alias("layer"), "n")
        for layer, frames in layers.items()
        for table, df in frames.items()
    ]
    columns = [F.max(F.when(F.col("layer") == layer, F.col("n"))).alias(f"{layer}_rows") for layer in layers]
    return reduce(DataFrame.unionByName, counted).groupBy("table_name").agg(*columns)

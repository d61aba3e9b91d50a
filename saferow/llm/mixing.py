"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target size (its weight's share of all words, limited to
``cap`` times its own size, the excess reshared by weight).  Target over size
is the expected number of copies of each of its documents: a whole part that
all get, and a fraction.  Fractions are rounded in pairs: words are moved at
random from one document of a pair to the other, with expectation unchanged,
until one of the two is whole; the other goes on to the next pair.  So the sum
of words is kept in every step and a source misses its target by less than one
document.

Distribution: units (id, source, size) are dealt to leaves by a hash of the
id, about ``leaf`` units each, so a source that holds a third of all rows is
spread over as many leaves as any other.  A leaf leaves at most one fractional
unit per source; those meet ``FAN_IN`` leaves at a time in a reduction tree,
until one per source is left, which is rounded by its own probability.  The
random numbers depend on (seed, level, source, node) alone and the order in a
node on sizes and ids, so reruns agree whatever the partitioning.  Large units
come first: the many small ones after them make them whole.

Defined results: null text has size 0; null sources form one source, last in
order; a unit of size 0 is rounded alone (it moves no words); of n rows that agree in
id, source and size, floor(n p) get the extra copy outright and one row with the rest of n p
goes into the pairing; an empty table gives no rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saferow.llm.common import stored
from saferow.operators.ranks import row_index

FAN_IN = 64
WORD = r"[^\x20\x09-\x0D]+"
_EPS = 1e-12


def n_words(col) -> "F.Column":
    return F.when(col.isNull(), F.lit(0)).otherwise(F.regexp_count(col, F.lit(WORD))).cast("long")


def source_targets(units: DataFrame, weights=(1, 2, 3), cap: float = 3.0) -> DataFrame:
    """One row per source: source_size, target, and its rank ``source_no``.

    Sources in code point order, null last, take the weights in turn.  The
    limited shares are found in one sweep by size per weight: in that order the
    limited sources come first, and the level of the rest is what is left over
    the weight that is left.  The table has one row per source.
    """
    src = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n_rows")).cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("source_no") % len(weights) + 1).cast("int"))
    src = src.withColumn("source_no", F.row_number().over(order) - 1).withColumn("weight", w)
    src = src.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    sweep = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    prior = sweep.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(prior), F.lit(0.0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(prior), F.lit(0.0))
    src = src.withColumn("level", left / weight_left)
    free = F.when(F.col("most") > F.col("level") * F.col("weight"), F.col("level"))
    first_free = F.min(F.struct(F.when(free.isNull(), 1).otherwise(0).alias("limited"),
                                (F.col("most") / F.col("weight")).alias("at"),
                                F.col("source_no"), free.alias("level"))).over(whole)
    level = first_free["level"]
    target = F.when(level.isNull(), F.col("most")).otherwise(
        F.least(F.col("most"), level * F.col("weight")))
    return src.select("source", "source_no", "source_size", target.alias("target"))


_UNIT = "doc_id long, source string, size long, n_rows long, source_no int, source_size long, target double"
_OPEN = _UNIT + ", base long, more long, p double, node long, open boolean"


def _pair(i: list, j: list, u: float) -> tuple[list, list | None]:
    """Move words between units [row, p, words]; gives (whole one, the other or None)."""
    (_, p, s), (_, q, t) = i, j
    to_i, to_j = min((1 - p) * s, q * t), min(p * s, (1 - q) * t)
    if u * (to_i + to_j) < to_j:
        if (1 - p) * s <= q * t:
            i[1], j[1], done, rest = 1.0, q - to_i / t, i, j
        else:
            i[1], j[1], done, rest = p + to_i / s, 0.0, j, i
    elif p * s <= (1 - q) * t:
        i[1], j[1], done, rest = 0.0, q + to_j / t, i, j
    else:
        i[1], j[1], done, rest = p - to_j / s, 1.0, j, i
    return done, rest


def _rounder(seed: int, level: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, rng, out = None, None, None, []
        schema = None

        def close(unit, still_open):
            row, p, _ = unit
            if not still_open:
                row["more"] += 1 if p >= 0.5 else 0
            row["p"], row["open"] = p, still_open
            out.append(row)

        def settle():
            nonlocal held
            if held is not None:
                if last:
                    held[1] = 1.0 if rng.random() < held[1] else 0.0
                close(held, not last)
            held = None

        for batch in batches:
            schema = schema or batch.schema
            for row in batch.to_pylist():
                if (row["source_no"], row["node"]) != group:
                    settle()
                    group = (row["source_no"], row["node"])
                    rng = random.Random(f"{seed}/{level}/{group}")
                unit = [row, row["p"], row["size"]]  # one row stands for the rest of its unit
                if unit[2] == 0 and _EPS < unit[1] < 1 - _EPS:
                    unit[1] = 1.0 if rng.random() < unit[1] else 0.0
                if unit[1] <= _EPS or unit[1] >= 1 - _EPS:
                    close(unit, False)
                elif held is None:
                    held = unit
                else:
                    done, held = _pair(held, unit, rng.random())
                    close(done, False)
                    if held[1] <= _EPS or held[1] >= 1 - _EPS:
                        close(held, False)
                        held = None
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out.clear()
        settle()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def mix(units: DataFrame, weights=(1, 2, 3), cap: float = 3.0, seed: int = 17, leaf: int = 4096) -> DataFrame:
    """``units`` (doc_id, source, size) -> for each distinct unit and number of copies: the rows
    (``n_rows`` of them, from number ``from_row`` on) that are taken ``copies`` times, with source_size and target."""
    units = stored(units.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n_rows")), "mix-units")
    src = source_targets(units, weights, cap)
    leaves = max(1, -(-units.count() // leaf))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))) \
        .otherwise(F.lit(0.0))
    rows = (units.join(src.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
            .withColumn("base", F.floor(rate + _EPS))
            .withColumn("all", F.col("n_rows") * F.greatest(rate - F.col("base"), F.lit(0.0)))
            .withColumn("more", F.least(F.floor(F.col("all") + _EPS), F.col("n_rows")))
            .withColumn("p", F.greatest(F.col("all") - F.col("more"), F.lit(0.0)))
            .withColumn("node", F.pmod(F.xxhash64("doc_id", "size"), F.lit(leaves)))
            .withColumn("open", F.lit(True)))
    fields = [f.strip().split(" ")[0] for f in _OPEN.split(",")]
    rows = rows.select(*[F.col(c).cast(f.strip().split(" ")[1]) for c, f in zip(fields, _OPEN.split(","))])
    done, level, nodes = [], 0, leaves
    while True:
        last = nodes == 1
        got = (rows.repartition("source_no", "node").sortWithinPartitions("source_no", "node", F.desc("size"), "doc_id")
               .mapInArrow(_rounder(seed, level, last), _OPEN))
        got = stored(got, f"mix-level{level}")
        done.append(got.where(~F.col("open")))
        if last:
            break
        rows = got.where("open").withColumn("node", F.floor(F.col("node") / FAN_IN).cast("long"))
        nodes, level = -(-nodes // FAN_IN), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    some = F.array(F.struct(F.lit(0).cast("long").alias("from_row"), F.col("more").alias("n_rows"), (F.col("base") + 1).alias("copies")),
                   F.struct(F.col("more").alias("from_row"), (F.col("n_rows") - F.col("more")).alias("n_rows"), F.col("base").alias("copies")))
    out = out.select("doc_id", "source", "size", "source_size", "target", F.explode(some).alias("some")).where("some.n_rows > 0")
    return out.select("doc_id", "source", "size", "source_size", "target", "some.n_rows", "some.copies", "some.from_row")


def units_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source"),
                       n_words(F.col("text")).alias("size"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it (columns kept)."""
    plan = stored(mix(units_of(docs), **options), "mix-plan").select(
        F.col("doc_id").alias("__sf_id"), F.col("source").alias("__sf_source"), F.col("size").alias("__sf_size"),
        F.col("from_row").alias("__sf_from"), F.col("n_rows").alias("__sf_n"), F.col("copies").alias("__sf_copies"))
    unit = ["__sf_id", "__sf_source", "__sf_size"]
    keyed = docs.withColumn("__sf_words", n_words(F.col("text")))

    def planned(rows: DataFrame, side: DataFrame, how: str = "inner") -> DataFrame:
        on = (rows["doc_id"].eqNullSafe(side["__sf_id"]) & rows["source"].eqNullSafe(side["__sf_source"])
              & (rows["__sf_words"] == side["__sf_size"]))
        return rows.join(side, on, how)

    def taken(rows: DataFrame) -> DataFrame:
        copies = F.explode(F.sequence(F.lit(1), F.col("__sf_copies").cast("int")))
        return rows.where("__sf_copies > 0").select(*[F.col(f"`{c}`") for c in docs.columns], copies.alias("__sf_copy")).drop("__sf_copy")

    # units of one row, and of rows that all get as many copies: every row alike
    mixed_units = plan.where("__sf_from > 0").select(*unit)  # some rows of these get one copy more
    alike = plan.where("__sf_from = 0").alias("p")
    differ = mixed_units.select(*[F.col(c).alias(c + "2") for c in unit])
    same = [F.col(c).eqNullSafe(F.col(c + "2")) for c in unit]
    out = taken(planned(keyed, alike.join(differ, same, "left_anti")))
    if mixed_units.isEmpty():
        return out
    # the rows of the others are numbered: those below ``from_row`` get the copy more
    rows = planned(keyed, mixed_units, "left_semi")
    numbered = row_index(rows.withColumn("__sf_none", F.col("doc_id").isNull()),
                         ["__sf_none", "doc_id", "source", "__sf_words"], out="__sf_no").drop("__sf_none")
    first = numbered.groupBy("doc_id", "source", "__sf_words").agg(F.min("__sf_no").alias("__sf_first")) \
        .select(F.col("doc_id").alias("__sf_id"), F.col("source").alias("__sf_source"), F.col("__sf_words").alias("__sf_size"), "__sf_first")
    both = stored(plan.join(first, unit_equal(plan, first, unit)).select(*[plan[c] for c in plan.columns], "__sf_first"), "mix-ranges")
    place = F.col("__sf_no") - F.col("__sf_first")
    numbered = planned(numbered, both).where((place >= F.col("__sf_from")) & (place < F.col("__sf_from") + F.col("__sf_n")))
    return out.unionByName(taken(numbered))


def unit_equal(a: DataFrame, b: DataFrame, unit: list[str]):
    """Equality of units, null equal to null."""
    cond = F.lit(True)
    for c in unit:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond

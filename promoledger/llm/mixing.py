"""Mixing sources to target weights by dependent rounding of copy probabilities.

Every row of a source starts with the same number of copies, target words / source words. The whole
part is certain. The fractional parts are settled in pairs: mass (words times probability) moves at
random from one row to the other until one of them is 0 or 1, so the expected copies of each row and
the words of the pair are kept. Rows meet in small groups; each group leaves at most one unsettled
row, and those meet in the next level of a reduction tree. Words of a source therefore miss their
target by less than one row. Only ids, sizes and sources move; all steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoledger.operators.numbering import number_rows, rank_within
from promoledger.session import materialize

WEIGHTS, MOST_COPIES, GROUP, SEED = (5.0, 2.0, 1.0), 3.0, 32, 20261
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size, n_items, target) from rows of (source, size, n_rows).

    Weights go round over the sources in code point order, NULL last. Targets share all words by
    weight and stop at ``most`` times the source's words; the excess goes to the others by weight.
    Finding the stopped sources takes a few sums over the list of sources; only sums reach the driver.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n_rows")).alias("source_size"), F.count(F.lit(1)).alias("n_items"))
    ranked = number_rows(per, [F.col("source").asc_nulls_last()], "__no")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("__no") - 1, F.lit(len(weights))) + 1).cast("int"))
    listed = materialize(ranked.withColumn("__w", weight), "sources")
    cap = most * F.col("source_size")
    total = listed.agg(F.sum("source_size")).first()[0] or 0
    level, stopped_before = 0.0, -1
    while True:
        # Sources above the level stop at their cap; the level rises until no further one stops.
        stopped = cap < F.col("__w") * level if stopped_before >= 0 else F.lit(False)
        n, held, free = listed.agg(F.count_if(stopped), F.sum(F.when(stopped, cap)), F.sum(F.when(~stopped, F.col("__w")))).first()
        if n == stopped_before or not free:
            break
        level, stopped_before = (total - (held or 0.0)) / free, n
    return listed.select("source", "source_size", "n_items", F.least(cap, F.col("__w") * level).alias("target"))


def _draw(*parts: Column) -> Column:
    """A number in [0, 1) fixed by the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(1 << 53)


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """One row per distinct (doc_id, source, size, copies) with ``n_rows``, ``source_size``, ``target``.

    Rows that agree in id, source and size differ by at most one copy: of n such rows with a fractional part p, floor(n * p) get
    one copy more, and one further row stands for the rest in the rounding. Rows without words get the whole
    part of their source's copies (none if the source has no words). Sizes may tie. NULL ids and NULL sources are
    values like others; an empty table gives no rows.
    """
    lumps = _plan_lumps(docs, id_col, text_col, source_col, weights, most, seed)
    more = F.struct((F.col("copies") + 1).alias("copies"), F.col("extra").alias("n_rows"))
    plain = F.struct(F.col("copies"), (F.col("n_rows") - F.col("extra")).alias("n_rows"))
    parts = lumps.withColumn("__part", F.explode(F.array(more, plain))).filter("__part.n_rows > 0")
    return parts.select("doc_id", "source", "size", "__part.n_rows", "source_size", "target", "__part.copies")


def _plan_lumps(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[float, ...], most: float, seed: int) -> DataFrame:
    """One row per distinct (doc_id, source, size): of its ``n_rows`` rows ``extra`` get one more than ``copies``."""
    sizes = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"))
    items = materialize(sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n_rows")), "mix-sizes")
    targets = materialize(source_targets(items, weights, most), "mix-targets")
    known = items.join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    near = F.when(F.abs(rate - F.round(rate)) < 1e-12, F.round(rate)).otherwise(rate)
    known = known.withColumn("__rate", near).withColumn("__whole", F.floor("__rate").cast("int"))
    words = F.col("size").cast("double")
    # Of rows that agree, so many get one copy more for certain; one row carries the rest.
    wanted = F.when(words > 0, F.col("n_rows") * (F.col("__rate") - F.col("__whole"))).otherwise(F.lit(0.0))
    known = known.withColumn("__sure", F.floor(wanted)).withColumn("__rest", wanted - F.col("__sure"))
    part = F.col("__rest")
    open_ = part > 0
    fields = ["doc_id", "source", "size"]
    largest = targets.agg(F.max("n_items")).first()[0] or 0
    group = F.pmod(F.xxhash64(*fields, F.lit(seed)), F.ceil(F.col("n_items") / GROUP))
    unsettled = known.filter(open_).select("source", group.alias("__group"), F.struct(*fields).alias("key"), words.alias("a"), (words * part).alias("x"))
    settled = []
    groups, levels = -(-largest // GROUP), 1
    while groups > 1:
        groups, levels = -(-groups // GROUP), levels + 1
    for level in range(levels):
        step = materialize(_level(unsettled, seed + level), f"mix-level-{level}")
        settled.append(step.select(F.explode("s.done").alias("d")).select("d.key", "d.up"))
        unsettled = step.filter("s.carry is not null").select("source", F.floor(F.col("__group") / GROUP).alias("__group"), "s.carry.key", "s.carry.a", "s.carry.x")
    last = unsettled.select("key", (_draw(F.col("key"), F.lit(seed + 99)) < F.col("x") / F.col("a")).cast("int").alias("up"))
    ups = last
    for frame in settled:
        ups = ups.unionByName(frame)
    ups = ups.select(*[F.col(f"key.{f}").alias(f"__{f}") for f in fields], "up")
    same = [F.col(f).eqNullSafe(F.col(f"__{f}")) for f in fields]
    return known.join(ups, same, "left").select(
        *fields, "n_rows", "source_size", "target", F.col("__whole").alias("copies"), (F.col("__sure") + F.coalesce("up", F.lit(0))).alias("extra")
    )


def _level(unsettled: DataFrame, salt: int) -> DataFrame:
    """Settle each (source, group); ``s`` holds the settled rows and the one left."""
    grouped = unsettled.groupBy("source", "__group").agg(
        F.sort_array(F.collect_list(F.struct(F.xxhash64("key", F.lit(salt)).alias("h"), "key", "a", "x"))).alias("items")
    )
    key = unsettled.schema["key"].dataType.simpleString()
    # Per step: c is the carried row, i the next one. lift / drop: the mass that can move to c / to i.
    return grouped.selectExpr(
        "source",
        "__group",
        f"""aggregate(
              slice(items, 2, size(items)),
              named_struct('done', cast(array() as array<struct<key:{key},up:int>>),
                           -- nullable: two rows may settle each other and leave none
                           'carry', if(size(items) > 0, named_struct('key', items[0].key, 'a', items[0].a, 'x', items[0].x), null)),
              (s, i) -> case when s.carry is null then
                named_struct('done', s.done, 'carry', named_struct('key', i.key, 'a', i.a, 'x', i.x))
              else transform(array(named_struct(
                  'lift', least(s.carry.a - s.carry.x, i.x),
                  'drop', least(s.carry.x, i.a - i.x),
                  'u', shiftrightunsigned(xxhash64(s.carry.key, i.key, {salt}), 11) / {float(1 << 53)}D)),
                m -> case when m.u * (m.lift + m.drop) < m.drop then
                  case when s.carry.a - s.carry.x = m.lift and i.x = m.lift then
                    named_struct('done', concat(s.done, array(named_struct('key', s.carry.key, 'up', 1), named_struct('key', i.key, 'up', 0))),
                                 'carry', cast(null as struct<key:{key},a:double,x:double>))
                  when s.carry.a - s.carry.x = m.lift then
                    named_struct('done', concat(s.done, array(named_struct('key', s.carry.key, 'up', 1))),
                                 'carry', named_struct('key', i.key, 'a', i.a, 'x', i.x - m.lift))
                  else
                    named_struct('done', concat(s.done, array(named_struct('key', i.key, 'up', 0))),
                                 'carry', named_struct('key', s.carry.key, 'a', s.carry.a, 'x', s.carry.x + m.lift))
                  end
                else
                  case when s.carry.x = m.drop and i.a - i.x = m.drop then
                    named_struct('done', concat(s.done, array(named_struct('key', s.carry.key, 'up', 0), named_struct('key', i.key, 'up', 1))),
                                 'carry', cast(null as struct<key:{key},a:double,x:double>))
                  when s.carry.x = m.drop then
                    named_struct('done', concat(s.done, array(named_struct('key', s.carry.key, 'up', 0))),
                                 'carry', named_struct('key', i.key, 'a', i.a, 'x', i.x + m.drop))
                  else
                    named_struct('done', concat(s.done, array(named_struct('key', i.key, 'up', 1))),
                                 'carry', named_struct('key', s.carry.key, 'a', s.carry.a, 'x', s.carry.x - m.drop))
                  end
                end)[0] end) as s""",
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with each row as many times as the mix takes it; columns unchanged.

    Options are those of ``plan_mix``, whose docstring states the results for NULLs, repeated rows,
    texts without words and empty tables. Which of the rows that agree in id, source and size get the further copy
    follows the order in which they were written down once; their number may be any.
    """
    plan = _plan_lumps(docs, id_col, text_col, source_col, weights, most, seed).select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"),
        F.col("copies").alias("__copies"), F.col("extra").alias("__extra"), F.col("n_rows").alias("__n"),
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    keyed = docs.select(row, F.col(id_col).alias("__key"), F.col(source_col).cast("string").alias("__from"), word_count(F.col(text_col)).alias("__words"))
    same = F.col("__key").eqNullSafe(F.col("__id")) & F.col("__from").eqNullSafe(F.col("__source")) & (F.col("__words") == F.col("__size"))
    differ = (F.col("__extra") > 0) & (F.col("__extra") < F.col("__n"))
    all_same = F.col("__copies") + (F.col("__extra") > 0).cast("int")
    if plan.filter((F.col("__n") > 1) & differ).isEmpty():
        taken = keyed.join(plan, same).withColumn("__times", all_same)
    else:
        joined = keyed.join(plan, same)
        # Written once, so that a row keeps its number; a lump of very many rows is numbered in parts.
        tied = materialize(joined.filter(differ).withColumn("__no", F.monotonically_increasing_id()), "mix-tied")
        ranked = rank_within(tied, ["__id", "__source", "__size"], [F.col("__no")], "__rank").drop("__no")
        picked = ranked.withColumn("__times", F.col("__copies") + (F.col("__rank") <= F.col("__extra")).cast("int")).drop("__rank")
        taken = joined.filter(~differ).withColumn("__times", all_same).unionByName(picked)
    taken = taken.filter("__times > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int"))))
    return taken.select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns])

"""Sources mixed to target weights by Pareto order sampling.

Every source has a target in words. A document is taken as often as the target
holds the whole source: these copies are certain. What the target lacks then
is a sample without replacement. Its documents are ranked by random odds
divided by the odds of inclusion, and the ranking is cut where the words reach
the target. The odds of inclusion follow from the share still wanted, and long
documents have lower ones than short ones, as one long text at the cut would
miss the target by its length. Where the next document would overshoot, the
ranking goes on with documents of at most the words that lack, three times, so
that a source ends within a small text of its target.

The cut is found without ranking a source in one task: words are added up per
source and interval of the rank, and only the interval that holds the cut is
looked at more closely. All of it is DataFrame aggregates and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.tables import join_salted, sums_before
from salesloom.session import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
INTERVALS = 4096
ROUNDS = 4
SEED = "mix-1"


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    between = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "a")
    return F.length(F.regexp_replace(between, r"[\x20\x09-\x0D]+", "")).cast("long")


def source_key(source: Column) -> Column:
    """Text that orders sources by code point and null last, and is never null."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Targets of sources with the columns ``key`` and ``source_size``; one row per source.

    Weights repeat over the sources in their order. Targets share ``share`` times
    all words by weight, none above ``cap`` times its source; the excess goes to
    the others by weight. That is the level at which the targets, cut at their
    caps, add up: sources are capped in the order of cap by weight.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights) + 1).cast("int"))
    placed = sums_before(sizes, [F.col("key")], position=F.lit(1))
    placed = placed.withColumn("position", F.col("position").cast("long")).withColumn("weight", weight.cast("double"))
    placed = placed.withColumn("most", cap * F.col("source_size"))
    by_cap = [F.col("most") / F.col("weight"), F.col("position")]
    rows = stored(sums_before(placed, by_cap, capped=F.col("most"), passed=F.col("weight")), "mix-sources")
    words, all_weights = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    # the level rises while sources are capped rightly and falls once one is capped too early
    at = (F.lit(share * (words or 0)) - F.col("capped")) / (F.lit(all_weights or 0.0) - F.col("passed"))
    level = rows.agg(F.max(at)).first()[0]
    target = F.least(F.col("most"), F.lit(level).cast("double") * F.col("weight"))
    return rows.select("key", "source_size", target.alias("target"))


def base_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, carry: list[str] | None) -> DataFrame:
    """A row per document: ``doc`` (the columns carried), its id, size, source key, and random odds.

    The odds are a hash of what tells rows apart, ``mark``, and of an ordinal among
    the rows that have the same. Stored once, so that a row has the same number in all steps.
    """
    key = source_key(docs[source_col])
    name = F.coalesce(docs[id_col].cast("string"), F.lit("-"))
    rows = stored(
        docs.select(
            F.struct(*[docs[c] for c in carry or docs.columns]).alias("doc"),
            docs[id_col].alias("doc_id"),
            n_words(docs[text_col]).alias("size"),
            key.alias("key"),
            F.md5(F.concat(name, F.lit(":"), key, F.lit(":"), F.coalesce(docs[text_col], F.lit("")))).alias("mark"),
            F.monotonically_increasing_id().alias("row"),
            F.spark_partition_id().alias("part"),
        ),
        "mix-rows",
    )
    repeated = stored(rows.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark"), "repeated")
    if repeated.isEmpty():
        rows = rows.withColumn("ordinal", F.lit(0).cast("long"))
    else:
        rows = rows.join(ordinals(rows.join(repeated, "mark", "left_semi")), "row", "left")
        rows = rows.withColumn("ordinal", F.coalesce("ordinal", F.lit(0).cast("long")))
    return rows.withColumn("odds", random_odds(F.col("mark"), F.col("ordinal"))).drop("mark", "part", "ordinal")


def ordinals(rows: DataFrame) -> DataFrame:
    """``row`` and ``ordinal``: 0, 1, 2... among rows of one mark.

    Numbered within each part they were read in, and then from where the parts
    before end, so that no task gets more rows of a mark than one part has.
    """
    inside = Window.partitionBy("part", "mark").orderBy("row")
    earlier = Window.partitionBy("mark").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.select("row", "part", "mark", (F.row_number().over(inside) - 1).alias("place"))
    counts = rows.groupBy("mark", "part").agg(F.count("*").alias("n"))
    starts = counts.select("mark", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    found = placed.join(starts, ["mark", "part"]).select("row", (F.col("place") + F.col("start")).alias("ordinal"))
    return stored(found, "ordinals")


def random_odds(mark: Column, ordinal: Column, seed: str = SEED) -> Column:
    """u / (1 - u) for a u of (0, 1) that is a hash of the row."""
    digest = F.sha2(F.concat(F.lit(seed + ":"), mark, F.lit(":"), ordinal.cast("string")), 256)
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(2**48)
    return u / (1.0 - u)


def rank_of(odds: Column, size: Column, share: Column, mean_size: Column) -> Column:
    """Random odds by odds of inclusion, brought from (0, inf) to (0, 1)."""
    evenly = F.sqrt(mean_size / F.greatest(size.cast("double"), mean_size))
    open_odds = F.when(share > 0, share / (1.0 - share))  # null, and no rank, where nothing is open
    ratio = odds / (open_odds * evenly)
    return ratio / (1.0 + ratio)


def _cut(rows: DataFrame, room: DataFrame) -> DataFrame:
    """The first rank of each source that finds no room, and the words before it.

    ``rows`` have key, size and rank; ``room`` has key and room, in words.
    Rows of one rank stay together. The rank is above 1 where all find room.
    """
    order = Window.partitionBy("key").orderBy("at")

    def crossing(inside: DataFrame, at: Column) -> DataFrame:
        """The first interval of a source that does not fit whole, and the words before it."""
        sums = inside.groupBy("key", "room", "before", at.alias("at")).agg(F.sum("size").alias("words"))
        upto = sums.withColumn("upto", F.sum("words").over(order) + F.col("before"))
        first = upto.where("upto > room").groupBy("key", "room").agg(
            F.min("at").alias("lo"), F.min(F.col("upto") - F.col("words")).alias("before")
        )
        return first

    width = 1.0
    start = room.withColumn("before", F.lit(0).cast("long"))
    inside = join_salted(rows, start, "key", "rank", "inner")
    for _ in range(2):
        width /= INTERVALS
        edge = crossing(inside, F.floor(F.col("rank") / width) * F.lit(width))
        inside = join_salted(rows, edge, "key", "rank", "inner").where(
            (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("lo") + width)
        )
    ends = crossing(inside, F.col("rank")).select("key", F.col("lo").alias("end"), F.col("before").alias("words"))
    whole = rows.groupBy("key").agg(F.sum("size").alias("all_words"))
    return (
        room.select("key").join(ends, "key", "left").join(whole, "key", "left")
        .select("key", F.coalesce("end", F.lit(2.0)).alias("end"),
                F.coalesce("words", "all_words", F.lit(0).cast("long")).alias("words"))
    )


def plan_mix(slim: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """What each source needs to decide on a document: one row per source.

    ``slim`` has key, size and odds, and is read several times. Columns: key,
    source_size, target, whole (certain copies), open_share (the share that
    remains), mean_size, and end_i, most_i of each round: a document of at most
    most_i words whose rank is below end_i is taken once more.
    """
    sizes = slim.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = sizes.join(targets(sizes.select("key", "source_size"), weights, share, cap).select("key", "target"), "key")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = sources.select(
        "key", "source_size", "target",
        F.floor(ratio).alias("whole"),
        (ratio - F.floor(ratio)).alias("open_share"),
        F.greatest(F.col("source_size") / F.col("n"), F.lit(1.0)).alias("mean_size"),
        (F.col("target") - F.floor(ratio) * F.col("source_size")).alias("room"),
    )
    plan = stored(plan.withColumn("most_1", F.col("source_size")), "mix-plan")
    open_ = plan.where("open_share > 0").select("key", "open_share", "mean_size")
    ranked = join_salted(slim.where("size > 0"), open_, "key", "odds", "inner")
    ranked = ranked.select("key", "size", rank_of(F.col("odds"), F.col("size"), F.col("open_share"), F.col("mean_size")).alias("rank"))
    for i in range(1, ROUNDS + 1):
        left = ranked
        if i > 1:
            last = plan.select("key", f"most_{i}", f"end_{i - 1}")
            left = join_salted(ranked, last, "key", "rank", "inner").where(
                f"size <= most_{i} AND rank >= end_{i - 1}"
            ).select("key", "size", "rank")
        cut = _cut(left, plan.where("open_share > 0").select("key", "room"))
        plan = plan.join(cut, "key", "left").withColumnRenamed("end", f"end_{i}")
        plan = plan.withColumn("room", F.col("room") - F.coalesce("words", F.lit(0).cast("long"))).drop("words")
        if i < ROUNDS:
            plan = plan.withColumn(f"most_{i + 1}", F.floor("room"))
        plan = stored(plan, "mix-plan")
    return plan


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, cap: float = CAP, carry: list[str] | None = None) -> DataFrame:
    """How the mix takes every document, one row each, with its columns ``carry``, by default all, as ``doc``.

    ``doc_id``, ``size`` words, ``source_size``, ``target`` of its source, ``copies``
    and ``taken`` = copies times size. A null text has no words, null is a source
    of its own and comes last, and a document without words is taken as often as
    its source is whole. Texts of any length count whole; a document longer than
    the words its source lacks is not drawn. Every row is drawn for itself, also
    of rows that share an id or are alike in id, text and source. Rows of one rank,
    which two hashes of 48 bits would have to share, stay together. A source
    without words has target 0. An empty table gives no rows. The draw is a hash
    of id, source, text and an ordinal of rows alike: runs agree.
    """
    base = base_rows(docs, id_col, text_col, source_col, carry)
    slim = stored(base.select("key", "size", "odds"), "mix-sizes")
    plan = plan_mix(slim, weights, share, cap)
    rows = join_salted(base, plan, "key", "row", "inner")
    rank = rank_of(F.col("odds"), F.col("size"), F.col("open_share"), F.col("mean_size"))
    drawn = F.lit(False)
    for i in range(1, ROUNDS + 1):
        drawn |= (F.col("size") <= F.col(f"most_{i}")) & (F.col("rank") < F.col(f"end_{i}"))
    drawn = F.coalesce((F.col("open_share") > 0) & (F.col("size") > 0) & drawn, F.lit(False))
    copies = F.col("whole") + drawn.cast("long")
    return rows.withColumn("rank", rank).select(
        "doc", "doc_id", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mixed(docs: DataFrame, **columns) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their columns."""
    taken = mix(docs, **columns).where("copies > 0")
    return taken.select(
        "doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")
    ).select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def _sql() -> str:
    rounds = []
    for i in range(1, ROUNDS + 1):
        rows = "ranked" if i == 1 else (
            f"(SELECT r.* FROM ranked r JOIN p{i - 1} p USING (key) "
            f"WHERE size <= floor(p.room) AND rank >= p.stop)"
        )
        before = "plan" if i == 1 else f"p{i - 1}"
        rounds.append(f"""
r{i} AS (SELECT key, size, rank, sum(size) OVER (PARTITION BY key ORDER BY rank) AS upto FROM {rows}),
c{i} AS (SELECT p.key, coalesce(min(rank) FILTER (WHERE upto > p.room), 2.0) AS stop
         FROM {before} p LEFT JOIN r{i} USING (key) GROUP BY p.key),
p{i} AS (SELECT p.* EXCLUDE (room, most, stop), c.stop,
                {'most' if i == 1 else 'floor(p.room)'} AS most,
                p.room - coalesce((SELECT sum(size) FROM r{i} r WHERE r.key = p.key AND rank < c.stop), 0) AS room
         FROM {before} p JOIN c{i} c USING (key))""")
    drawn = " OR ".join(f"(size <= p{i}.most AND rank < p{i}.stop)" for i in range(1, ROUNDS + 1))
    joins = " ".join(f"LEFT JOIN p{i} ON p{i}.key = d.key" for i in range(1, ROUNDS + 1))
    return f"""
WITH docs AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         (CAST('0x' || substr(sha256('{SEED}:' || mark || ':' || (row_number() OVER (PARTITION BY mark) - 1)), 1, 12) AS BIGINT)
          + 0.5::DOUBLE) / {2**48}::DOUBLE AS u
  FROM (SELECT *, md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || CASE WHEN source IS NULL THEN '1' ELSE '0' || source END
                      || ':' || coalesce(text, '')) AS mark FROM documents)),
sizes AS (SELECT key, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n,
                 row_number() OVER (ORDER BY key) - 1 AS position FROM docs GROUP BY key),
weighed AS (SELECT *, CAST([3, 1, 2][CAST(position % 3 + 1 AS BIGINT)] AS DOUBLE) AS weight,
                   {CAP}::DOUBLE * source_size AS most FROM sizes),
levels AS (SELECT *, ({SHARE}::DOUBLE * sum(source_size) OVER ()
                      - coalesce(sum(most) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
           FROM weighed WINDOW before AS (ORDER BY most / weight, position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
aimed AS (SELECT key, source_size, n, most, least(most, max(level) OVER () * weight) AS target FROM levels),
plan AS (SELECT key, source_size, target, floor(ratio) AS whole, ratio - floor(ratio) AS open_share,
                greatest(source_size / n::DOUBLE, 1.0) AS mean_size, target - floor(ratio) * source_size AS room,
                source_size::DOUBLE AS most, 2.0::DOUBLE AS stop
         FROM (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM aimed)),
placed AS (SELECT d.*, plan.open_share, plan.whole, (u / (1 - u)) / (open_share / (1 - open_share)
                  * sqrt(mean_size / greatest(CAST(size AS DOUBLE), mean_size))) AS q
           FROM docs d JOIN plan USING (key)),
ranked AS (SELECT key, size, q / (1 + q) AS rank, doc_id FROM placed WHERE size > 0 AND open_share > 0),
{','.join(rounds)}
SELECT d.doc_id, d.size, p1.source_size, p1.target,
       CAST(size * (p1.whole + CASE WHEN size > 0 AND d.open_share > 0 AND ({drawn}) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM (SELECT *, q / (1 + q) AS rank FROM placed) d {joins}
"""


SQL = _sql()

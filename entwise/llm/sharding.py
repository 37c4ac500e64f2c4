"""Documents into shards of equal row counts, with linked documents together,
by balanced label propagation. DataFrame and SQL functions only.

Documents with equal texts are neighbours of each other. Every document starts
in a shard by hash of its id. All neighbours of a group see the same votes, so a
round works on one row a group with its documents for each shard: the group asks
for the shard with most of them among those whose room holds it whole, or, if it
is larger than any room, for as many of the emptiest shards as it fills. Room is
a shard's quota less what was admitted to it: where documents stand that have not
been admitted yet takes no room, so what others leave is free in the same round.
Requests for a shard are ranked, larger ones first, and admitted up to its room;
who is not admitted asks again. Rounds go on until every linked document has its
shard, the largest groups first. A group is cut only where no room holds it. At
last the group's documents are dealt to its shards by rank. Documents without
neighbours, which cut no edge anywhere, then fill up the shards, which makes
counts differ by one at most.

Every round fulfils at least the first request for each shard asked for, and a
request of a group larger than any room closes its shard, so rounds end.

Only counts per shard reach the driver. A group's documents are never gathered:
its votes are at most one for each shard, ranks are dealt over salts, and the join
on the group reads written tables, so AQE splits a hot one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from entwise.llm.common import Work, ranked, running_offsets, spread

#: Groups ask in the same round as the largest one if they have more than this
#: part of its documents; smaller ones wait, as they fit beside the large.
TIER = 8


def _by_number(numbers: list[int], index: str) -> F.Column:
    return F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in numbers]), F.col(index) + 1)


def _asked(state: DataFrame, room: list[int], step: int) -> DataFrame:
    """(link, hub, need): the shards that each group asks for, and for how many
    documents; never more than the group has or the shard has room for."""
    most = max(room)
    shards = F.array(*[F.struct(F.lit(int(x)).cast("long").alias("room"), F.lit(s).alias("shard"))
                       for s, x in enumerate(room) if x > 0])

    def voted(c):
        return F.coalesce(F.col("votes")[c["shard"]], F.lit(0)).cast("long").alias("n")

    def tie(c):
        return F.xxhash64("link", c["shard"], F.lit(step)).alias("tie")

    whole = F.array_max(F.transform(F.filter(shards, lambda c: c["room"] >= F.col("left")),
                                    lambda c: F.struct(voted(c), tie(c), c["shard"].alias("shard"))))
    emptiest = F.sort_array(F.transform(shards, lambda c: F.struct(
        c["room"].alias("room"), voted(c), tie(c), c["shard"].alias("shard"))), asc=False)
    fills = F.slice(emptiest, 1, F.greatest(F.lit(1), F.floor(F.col("left") / most)).cast("int"))
    asked = F.when(F.col("left") <= most, F.array(F.struct(whole["shard"].alias("hub"), F.col("left").alias("need")))) \
        .otherwise(F.transform(fills, lambda c: F.struct(c["shard"].alias("hub"), c["room"].alias("need"))))
    return state.select("link", F.explode(asked).alias("r")).select("link", "r.hub", "r.need")


def _propagate(linked: DataFrame, quota: list[int], work: Work) -> tuple[DataFrame, list[int]]:
    """(link, shard, n): how many documents of each group go to which shard; and
    the documents in each shard."""
    spark, room = linked.sparkSession, list(quota)
    votes = linked.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("n")).groupBy("link").agg(
        F.sum("n").alias("left"), F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("votes"))
    state = work.table(votes, "votes")
    placed, step = None, 0
    while largest := state.agg(F.max("left")).first()[0]:
        asked = _asked(state.filter(F.col("left") * TIER > largest), room, step).withColumns(
            {"salt": spread(spark, "link"), "class": -F.floor(F.log2("need")).cast("int")})
        asked = work.table(asked, f"asked-{step}")
        # documents that ask for the same shard before: of larger requests, then by salt
        parts = running_offsets(asked.groupBy("hub", "class", "salt").agg(F.sum("need").alias("docs")),
                                ["hub"], ["class", "salt"], "docs", "before").drop("docs")
        line = Window.partitionBy("hub", "class", "salt").orderBy("link").rowsBetween(Window.unboundedPreceding, -1)
        admitted = asked.withColumn("inside", F.coalesce(F.sum("need").over(line), F.lit(0))) \
            .join(parts, ["hub", "class", "salt"]) \
            .filter(F.col("before") + F.col("inside") + F.col("need") <= _by_number(room, "hub"))
        admitted = work.table(admitted.select("link", F.col("hub").alias("shard"), F.col("need").alias("n")),
                              f"admitted-{step}")
        for r in admitted.groupBy("shard").agg(F.sum("n").alias("n")).collect():
            room[r.shard] -= r.n
        placed = admitted if placed is None else placed.unionAll(admitted)
        went = admitted.groupBy("link").agg(F.sum("n").alias("went"))
        state = work.table(state.join(went, "link", "left").select(
            "link", (F.col("left") - F.coalesce("went", F.lit(0))).alias("left"), "votes").filter("left > 0"), f"left-{step}")
        step += 1
    if placed is None:
        placed = state.select("link", F.lit(0).alias("shard"), F.col("left").alias("n"))
    return placed, [q - x for q, x in zip(quota, room)]


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, law (``rows``:
    counts differ by one at most), shard, slot (gapless from 0 in each shard) and
    grown_shard (null under this law) for every row of ``docs`` (doc_id, text).

    A null text has no bytes and no neighbours; an empty one has none of the
    former, and other empty ones as neighbours. Rows with a null or repeated
    doc_id are kept, each in a slot of its own. Extra columns are ignored; an
    empty table gives an empty result.
    """
    work = Work(docs.sparkSession, "sharding")
    rows = work.table(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_crc32"),
        F.unhex(F.sha2(F.col("text").cast("string"), 256)).alias("link"),
        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard")), "rows")
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]

    groups = work.table(rows.filter("link IS NOT NULL").groupBy("link").agg(F.count(F.lit(1)).alias("members"))
                        .filter("members > 1").select("link"), "groups")
    linked = work.table(rows.join(groups, "link", "left_semi").select(*rows.columns), "linked")
    single = rows.join(groups, "link", "left_anti").select(*rows.columns)
    state, load = _propagate(linked, quota, work)

    # a group's documents, by rank, to its shards
    till = F.sum("n").over(Window.partitionBy("link").orderBy("shard"))
    deals = work.table(state.withColumn("till", till).groupBy("link").agg(
        F.sort_array(F.collect_list(F.struct("till", "shard"))).alias("deals")), "deals")
    order = work.table(ranked(linked.drop("shard"), ["link"], ["doc_id"], "nth"), "ranked")
    placed = order.join(deals, "link").withColumn(
        "shard", F.filter("deals", lambda d: d["till"] > F.col("nth"))[0]["shard"])
    placed = placed.select(*rows.columns)
    ends, at = [], 0
    for q, x in zip(quota, load):
        at += q - x
        ends.append(at)
    free = ranked(single.withColumn("tie", F.xxhash64("link", "size")), [], ["doc_id", "tie"], "nth")
    filled = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= F.col("nth")))
    done = placed.unionAll(
        free.withColumn("shard", filled.cast("int")).select(*rows.columns))
    done = work.table(done, "done")
    return ranked(done, ["shard"], ["doc_id", "link"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))

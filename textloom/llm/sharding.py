"""Even shards by balanced label propagation: linked documents move towards each other."""

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import materialize, sized_join
from textloom.operators.ordering import ordered_index

N_SHARDS = 40
LINK = ["_g", "text_crc32", "size"]
PARTS = 1 << 20


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, _g): UTF-8 bytes plus 16, checksum and link key of each text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("_g"),
    )


def capacities(n_rows: int, n_shards: int) -> list[int]:
    return [n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)]


def pick(values: list, at: F.Column) -> F.Column:
    """Element ``at`` (0-based) of a short literal list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))


def spread_key(salt: int) -> F.Column:
    return F.pmod(F.xxhash64("doc_id", "_g", F.lit(salt)), F.lit(PARTS))


def propagate(linked: DataFrame, caps: list[int]) -> DataFrame:
    """Move linked rows (…, _gid, _n, label) to the shards that hold most of their neighbours.

    In each round a group of ``_n`` equal texts aims at the shards with room that hold most of its
    rows (without any, at those that hold most), as many of them as its rows need. The moves into a shard are admitted by gain (neighbours there minus
    neighbours here, by powers of two) until its free room is used; the last admitted class of
    gain moves a share of its rows. Only counts per shard and gain reach the driver, at most
    64 per shard. It ends when no row may move or a round moved none. It always does: a row only
    leaves a shard for one with at least as many of its group, so the sum of squares of a group's
    counts grows with every move.
    """
    n_shards = len(caps)
    most = max(caps)
    linked = linked.withColumn("moved", F.lit(False))
    for turn in count():
        counts = linked.groupBy("label").agg(F.count("*").alias("n"), F.count_if("moved").alias("moved")).collect()
        if turn and not any(r["moved"] for r in counts):
            return linked.drop("moved")
        loads = {r["label"]: r["n"] for r in counts}
        room = [max(0, caps[s] - loads.get(s, 0)) for s in range(n_shards)]
        held = linked.groupBy("_gid", "_n", "label").agg(F.count("*").alias("here"))
        held = materialize(held, "held")
        # At most one entry per shard in a group's list.
        order = F.sort_array(F.collect_list(F.struct("here", (-F.col("label")).alias("minus"))), asc=False)
        open_ones = F.filter(order, lambda x: pick(room, -x["minus"]) > 0)
        open_or_all = F.when(F.size(open_ones) > 0, open_ones).otherwise(order)
        wanted = F.ceil(F.col("_n") / F.lit(max(1, most))).cast("int")
        aims = held.groupBy("_gid", "_n").agg(open_or_all.alias("a")).select(
            "_gid", F.slice("a", 1, F.greatest(F.lit(1), wanted)).alias("aims")
        )
        moving = linked.join(aims.hint("merge"), "_gid").withColumn(
            "target",
            -F.element_at("aims", (F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.size("aims")) + 1).cast("int"))["minus"],
        )
        there = F.element_at("aims", (F.array_position(F.transform("aims", lambda x: -x["minus"]), F.col("target"))).cast("int"))["here"]
        moving = moving.withColumn("there", there).join(
            held.select("_gid", "label", "here").hint("merge"), ["_gid", "label"]
        )
        stays = F.exists("aims", lambda x: -x["minus"] == F.col("label"))
        gain = F.when(~stays & (F.col("there") >= F.col("here")), F.floor(F.log2(F.col("there") - F.col("here") + 1)))
        moving = materialize(
            moving.withColumn("gain", gain.cast("int")).drop("aims", "there", "here"), "moving"
        )
        demand = moving.filter("gain IS NOT NULL").groupBy("target", "gain").count().collect()
        share = {}
        for target in range(n_shards):
            left = room[target]
            for row in sorted((r for r in demand if r["target"] == target), key=lambda r: -r["gain"]):
                share[(target, row["gain"])] = min(1.0, left / row["count"])
                left = max(0, left - row["count"])
        if not any(share.values()):
            return moving.drop("moved", "target", "gain")
        levels = max(g for _, g in share) + 1
        flat = [share.get((t, g), 0.0) for t in range(n_shards) for g in range(levels)]
        admitted = spread_key(turn + 1) < pick(flat, F.col("target") * levels + F.col("gain")) * PARTS
        moved = F.coalesce(F.col("gain").isNotNull() & admitted, F.lit(False))
        linked = moving.withColumn("moved", moved)
        linked = linked.withColumn("label", F.when(F.col("moved"), F.col("target")).otherwise(F.col("label")))
        linked = linked.drop("target", "gain")


def cut_groups(placed: DataFrame) -> DataFrame:
    """One row (n_groups, n_cut, n_needed, cut_links) for placed rows (_g, shard, ...).

    Groups of equal texts with at least two rows, those in more than one shard, those that no
    shard could hold whole, and the links of a row with its group that end in another shard,
    counted per group and shard without listing them. Null texts belong to no group.
    """
    most = placed.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    held = placed.filter("_g IS NOT NULL").groupBy("_g", "shard").agg(F.count("*").alias("here"))
    groups = held.groupBy("_g").agg(
        F.sum("here").alias("n"), F.count("*").alias("shards"), F.sum(F.col("here") * F.col("here")).alias("inside")
    )
    zero = F.lit(0).cast("long")
    return groups.filter("n > 1").agg(
        F.count("*").alias("n_groups"),
        F.count_if(F.col("shards") > 1).alias("n_cut"),
        F.count_if(F.col("n") > most).alias("n_needed"),
        F.coalesce(F.sum((F.col("n") * F.col("n") - F.col("inside")) / 2).cast("long"), zero).alias("cut_links"),
    )


def balanced_shards(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, _g, shard, slot): row counts of shards differ by at most one.

    Rows with equal texts are linked (never as pairs: a group is its key) and kept in one shard
    where it can hold them; a group larger than a shard fills as few shards as it needs. Texts
    without a copy fill what is left. Slots number the rows of a shard from 0 without gaps. Null
    texts have the size 16 and checksum 0 and are linked with nothing. Repeated rows are rows of
    their own, and null ids are ids like others; an empty table gives no rows.
    """
    base = materialize(described(docs), "described")
    n_rows = base.count()
    caps = capacities(n_rows, n_shards)
    groups = materialize(
        base.filter("_g IS NOT NULL")
        .groupBy(*LINK)
        .agg(F.count("*").alias("_n"))
        .filter("_n > 1")
        .withColumn("_gid", F.monotonically_increasing_id()),
        "groups",
    )
    named = materialize(sized_join(base, groups, LINK), "named")
    linked = named.filter("_gid IS NOT NULL")
    start = F.when(F.col("doc_id").isNull(), F.xxhash64("_g")).otherwise(F.xxhash64("doc_id"))
    linked = linked.withColumn("label", F.pmod(start, F.lit(n_shards)).cast("int"))
    moved = materialize(propagate(linked, caps), "labels")
    loads = {r["label"]: r["count"] for r in moved.groupBy("label").count().collect()}
    free = [max(0, c - loads.get(s, 0)) for s, c in enumerate(caps)]
    edges = [PARTS * sum(free[: s + 1]) / max(1, sum(free)) for s in range(n_shards)]
    place = F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges[:-1]]), lambda e: spread_key(0) >= e))
    alone = named.filter("_gid IS NULL").withColumn("label", place.cast("int"))
    columns = ["doc_id", "size", "text_crc32", "_g", "label"]
    rows = moved.select(*columns, F.lit(0).alias("_late")).unionByName(
        alone.select(*columns, F.lit(1).alias("_late"))
    )
    return settle(rows, caps).select("doc_id", "size", "text_crc32", "_g", "shard", "slot")


def settle(rows: DataFrame, caps: list[int]) -> DataFrame:
    """Give every row its shard and slot: rows beyond a shard's capacity go to free slots."""
    n_shards = len(caps)
    ordered = rows.withColumn("_h", F.xxhash64("doc_id", "_g"))
    numbered = materialize(ordered_index(ordered, "label", "_late", "_h", "doc_id"), "numbered")
    counts = {r["label"]: r["count"] for r in numbered.groupBy("label").count().collect()}
    sizes = [counts.get(s, 0) for s in range(n_shards)]
    starts = [sum(sizes[:s]) for s in range(n_shards)]
    numbered = numbered.withColumn("slot", (F.col("row_index") - pick(starts, F.col("label"))).cast("long"))
    inside = F.col("slot") < pick(caps, F.col("label"))
    kept = numbered.filter(inside).withColumn("shard", F.col("label").cast("int"))
    over = ordered_index(numbered.filter(~inside).drop("row_index"), "label", "slot", name="_over")
    free = [max(0, caps[s] - sizes[s]) for s in range(n_shards)]
    ends = [sum(free[: s + 1]) for s in range(n_shards)]
    shard = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: F.col("_over") >= e)).cast("int")
    over = over.withColumn("shard", shard)
    slot = F.col("_over") - pick([e - f for e, f in zip(ends, free)], F.col("shard"))
    slot = slot + pick([min(c, s) for c, s in zip(caps, sizes)], F.col("shard"))
    over = over.withColumn("slot", slot.cast("long"))
    return kept.drop("row_index").unionByName(over.drop("_over"))


def op3(docs: DataFrame) -> DataFrame:
    return balanced_shards(docs.select("doc_id", "text")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

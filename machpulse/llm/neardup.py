"""Near-duplicate documents by bottom-k sketches.

One hash function orders all shingles; a document's sketch are its ``k`` smallest hashes. Texts with equal shingle
sets are one content from the start. The retained values form inverted lists. A pair that reaches the similarity
shares at least ``NEEDED`` of 32 values (the chance of fewer, at a similarity of exactly 0.8, is under one in a
million), so each content is listed only under its rarest ``size - needed + 1`` values, values that it has alone
included; passages that many texts share therefore make no lists. Candidates go through the union-sketch estimate
and are confirmed on the full shingle sets.

No list is expanded into all pairs. First each content meets the ``HUBS`` members of its lists whose values are the
most common, and components are formed. What is left are pairs of different components within a list with hub H.
They are found by their differences from H: similar sets differ from H in much the same shingles, so the pairs are made by
joining on the rarest few shingles of the differences (prefix and position filter, exact bounds); before that, each member meets its
nearest, so that texts that are alike one by one are one component. So every link that could join two
components is either confirmed or excluded, and no list or number of partners is capped.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from machpulse.llm.graph import components
from machpulse.llm.text import whole
from machpulse.sources.storage import passing_tables, stored

K = 32
NEEDED = 13
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
WHOLE_SET = 1 << 62
HUBS = 3
#: How often members left under a hub meet their nearest before all pairs that may still join components are looked at.
ROUNDS = 2


def _hasher(width: int, keep: int):
    """Arrow batches of (_id, _text) to the set size, two sums that identify the set, and its ``keep`` smallest hashes."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from machpulse.llm.arrays import mix, shingles, word_hashes

        def out(ids, sizes, first, second, kept):
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in kept])]).astype(np.int32)
            flat = np.concatenate(kept) if kept else np.zeros(0, np.uint64)
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(np.array(first, np.uint64).view(np.int64)),
                 pa.array(np.array(second, np.uint64).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))],
                names=["_id", "n", "s1", "s2", "hashes"],
            )

        for batch in batches:
            sizes, first, second, kept, begin, held = [], [], [], [], 0, 0
            for row, words in enumerate(word_hashes(batch.column("_text"))):
                found = shingles(words, width)
                sizes.append(len(found))
                first.append(np.sum(mix(found ^ np.uint64(SEEDS[0])), dtype=np.uint64))
                second.append(np.sum(mix(found ^ np.uint64(SEEDS[1])), dtype=np.uint64))
                kept.append(found[:keep])
                held += len(kept[-1])
                if held > 1 << 20:
                    yield out(batch.column("_id").slice(begin, row + 1 - begin), sizes, first, second, kept)
                    sizes, first, second, kept, begin, held = [], [], [], [], row + 1, 0
            if begin < batch.num_rows:
                yield out(batch.column("_id").slice(begin), sizes, first, second, kept)

    return run


def _hashed(lean: DataFrame, width: int, keep: int) -> DataFrame:
    schema = StructType([
        StructField("_id", lean.schema["_id"].dataType), StructField("n", LongType()), StructField("s1", LongType()),
        StructField("s2", LongType()), StructField("hashes", ArrayType(LongType())),
    ])
    return lean.mapInArrow(_hasher(width, keep), schema)


def _needed(size, k: int) -> Column:
    """Retained values that a pair shares at least, by the size of one sketch. Short sets are retained whole."""
    return F.when(size >= k, F.lit(NEEDED * k // K)).otherwise(F.greatest(F.lit(1), F.floor(size * 0.75).cast("int")))


def _lists(contents: DataFrame, k: int) -> DataFrame:
    """``value, rep, n, far``: each content under its rarest shared values; ``far`` is lower the more common they are."""
    postings = contents.select("rep", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    common = postings.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = postings.join(common, "value")
    mine = Window.partitionBy("rep", "n", "size")
    place = F.row_number().over(mine.orderBy("df", "value")) + F.col("size") - F.count(F.lit(1)).over(mine)
    kept = shared.withColumn("place", place).withColumn("far", -F.floor(F.sum("df").over(mine) / F.col("size"))).filter(
        F.col("place") <= F.col("size") - _needed(F.col("size"), k) + 1
    )
    return kept.select("value", "rep", "n", "far")


def _allowed(common, a: str, b: str, percent: int) -> Column:
    """Whether sets of these sizes are similar if they have so much in common."""
    return common * 100 >= percent * (F.col(a) + F.col(b) - common)


def _meeting(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Where members of one hub meet: ``hub, s, rep, n, d, component, outside, to_outside, to_inside``.

    ``rows``: ``hub, rep, n, component, hub_component``.

    A set is known by its difference D from the hub H: sets A and B differ as much as D(A) and D(B) do. Similar sets differ
    in at most ``r * (|A| + |B|)`` shingles, and a member A outside the hub's component differs from the hub in more than
    ``r * (|A| + |H|)``. So two similar sets of which one is such a member share part of their differences, and a least
    number of shared ones follows for each set by itself. They meet on the rarest shingles of their differences, as many as
    that number leaves: the common text that makes a list long is in no difference.
    """
    mine = sets.select(F.col("_id").alias("rep"), F.col("hashes").alias("_x"))
    theirs = sets.select(F.col("_id").alias("hub"), F.col("n").alias("hub_n"), F.col("hashes").alias("_h"))
    apart = F.concat(F.array_except("_x", "_h"), F.array_except("_h", "_x"))
    against = rows.join(mine, "rep").join(theirs, "hub").select("hub", "rep", "n", "component", "hub_component", "hub_n", apart.alias("apart"))
    facts = ["hub", "rep", "n", "component", "outside", "hub_n", "d"]
    against = against.withColumn("outside", F.col("component") != F.col("hub_component")).withColumn("d", F.size("apart"))
    single = stored(against.select(*facts, F.explode("apart").alias("s")), "neardup-differences")
    often = single.groupBy("hub", "s").agg(F.count(F.lit(1)).alias("df"), F.max("outside").alias("_any")).filter("df > 1 AND _any")
    # Shingles that no other difference under the hub has come first and meet nothing.
    shared = single.join(often.drop("_any"), ["hub", "s"])
    mine = Window.partitionBy(*facts)
    place = F.row_number().over(mine.orderBy("df", "s")) + F.col("d") - F.count(F.lit(1)).over(mine)
    less, more = 100 - percent, 100 + percent

    def needed(other_outside: bool) -> Column:
        """Shared differences with a similar set, outside the hub's component or not, by this set alone."""
        if other_outside:
            return F.greatest(F.lit(1), F.floor((F.col("d") * more - less * (F.col("n") - F.col("hub_n"))) / (2 * more)).cast("int") + 1)
        return F.greatest(F.lit(1), F.ceil((F.col("d") * more - less * (F.col("n") + F.col("hub_n"))) / (2 * more)).cast("int"))

    placed = shared.withColumn("place", place).withColumns(
        {"to_outside": F.col("place") <= F.col("d") - needed(True) + 1, "to_inside": F.col("outside") & (F.col("place") <= F.col("d") - needed(False) + 1)}
    ).filter("to_outside OR to_inside")
    return placed.select("hub", "s", "rep", "n", "d", "place", "component", "outside", "to_outside", "to_inside")


def _side(frame: DataFrame, letter: str) -> DataFrame:
    return frame.select("hub", "s", *[F.col(c).alias(f"{letter}_{c}") for c in _MEMBER])


_MEMBER = ("rep", "n", "d", "place", "component")


def _may_link(percent: int) -> Column:
    """Whether members of different components that meet on a shingle may be similar if it is the first that they share: what
    comes after it in both differences must be enough for the number that they need in common."""
    less, more = 100 - percent, 100 + percent
    after = F.least(F.col("x_d") - F.col("x_place"), F.col("y_d") - F.col("y_place")) + 1
    enough = 2 * more * after >= more * (F.col("x_d") + F.col("y_d")) - less * (F.col("x_n") + F.col("y_n"))
    return (F.col("x_component") != F.col("y_component")) & _sizes_allow("x_n", "y_n", percent) & enough


def _as_pairs(found: DataFrame) -> DataFrame:
    return found.select(F.least("x_rep", "y_rep").alias("a"), F.greatest("x_rep", "y_rep").alias("b")).distinct()


def _nearest_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """One pair ``a, b`` at most per hub and member: of those nearest to the hub under each of its shingles, the one that
    differs from the hub about as much. Long rows of texts, each like the next, become one component by these few pairs."""
    first = placed.groupBy("hub", "s").agg(F.min_by(F.struct(*_MEMBER), F.struct("d", "rep")).alias("t"))
    theirs = first.select("hub", "s", *[F.col(f"t.{c}").alias(f"y_{c}") for c in _MEMBER])
    found = _side(placed, "x").join(theirs, ["hub", "s"]).filter(_may_link(percent))
    apart = F.struct(F.abs(F.col("x_d") - F.col("y_d")), "y_rep")
    return _as_pairs(found.groupBy("hub", "x_rep").agg(F.min_by("y_rep", apart).alias("y_rep")))


def _open_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """All pairs ``a, b`` of different components that meet under a hub."""
    outside = placed.filter("outside AND to_outside")
    both_outside = _side(outside, "x").join(_side(outside, "y"), ["hub", "s"]).filter(_may_link(percent) & (F.col("x_rep") < F.col("y_rep")))
    one_inside = _side(placed.filter("to_inside"), "x").join(_side(placed.filter("NOT outside AND to_outside"), "y"), ["hub", "s"]).filter(_may_link(percent))
    return _as_pairs(both_outside.select("x_rep", "y_rep").unionByName(one_inside.select("x_rep", "y_rep")))


def _joined_components(placed: DataFrame, links: DataFrame) -> DataFrame:
    """``placed`` with the components that new links make of the present ones."""
    of = placed.select("rep", "component").distinct()
    edges = links.join(of.select(F.col("rep").alias("a"), F.col("component").alias("_a")), "a").join(
        of.select(F.col("rep").alias("b"), F.col("component").alias("_b")), "b"
    )
    merged = components(edges.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    moved = placed.join(merged.select("node", F.col("component").alias("_c")), F.col("component") == F.col("node"), "left")
    return moved.withColumn("component", F.coalesce("_c", "component")).select(*placed.columns)


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _estimated(pairs: DataFrame, contents: DataFrame, k: int) -> DataFrame:
    """The pairs ``a, b`` whose union sketch still allows the similarity."""
    left = contents.select(F.col("rep").alias("a"), F.col("sketch").alias("_x"))
    right = contents.select(F.col("rep").alias("b"), F.col("sketch").alias("_y"))
    union = F.slice(F.array_sort(F.array_union("_x", "_y")), 1, k)
    both = F.array_intersect(union, F.array_intersect("_x", "_y"))
    return pairs.join(left, "a").join(right, "b").filter(F.size(both) >= _needed(F.size(union), k)).select("a", "b").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("_id").alias("a"), F.col("n").alias("_n"), F.col("hashes").alias("_x"))
    right = sets.select(F.col("_id").alias("b"), F.col("n").alias("_m"), F.col("hashes").alias("_y"))
    both = F.size(F.array_intersect("_x", "_y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "_n", "_m", both.alias("_both"))
    return joined.filter(_allowed(F.col("_both"), "_n", "_m", percent)).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, id_col="doc_id", text_col="text", width: int = 5, percent: int = 80, k: int = K
) -> DataFrame:
    """One row per input row: ``id, n_shingles, component_id, kept``.

    A text's set are its distinct ``width``-word shingles, A-Z as a-z; with fewer words the whole sequence; without
    words (null, empty) the set is empty and linked with nothing. Documents with ``100 * |A & B| >= percent * |A | B|``
    are linked; ``component_id`` is the smallest id that can be reached, ``kept`` whether it is the row's own. Rows
    with the same id count as one document with several texts. A null id is linked with nothing, its component is
    null and it is kept. Other columns are ignored; an empty table gives none.
    """
    with passing_tables(docs.sparkSession):
        return stored(_found(docs, id_col, text_col, width, percent, k), "neardup", keep=True)


def _found(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, k: int) -> DataFrame:
    lean = docs.select(F.col(id_col).alias("_id"), whole(text_col).alias("_text"))
    sketches = stored(_hashed(lean, width, k), "neardup-sketches")
    named = sketches.filter("n > 0 AND _id IS NOT NULL")
    contents = stored(
        named.groupBy("n", "s1", "s2").agg(F.min("_id").alias("rep"), F.first("hashes").alias("sketch")), "neardup-contents"
    )
    lists = stored(_lists(contents, k), "neardup-lists")
    by_far = Window.partitionBy("value").orderBy("far", "rep", "n")
    tops = lists.withColumn("rank", F.row_number().over(by_far)).filter(F.col("rank") <= HUBS)
    members = lists.groupBy("value").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    hubs = stored(
        tops.join(members, "value").select("value", F.col("rep").alias("hub"), F.col("n").alias("hub_n"), "rank", "members"), "neardup-hubs"
    )
    lists = lists.join(hubs, "value")
    to_hub = (
        lists.filter((F.col("rep") != F.col("hub")) & _sizes_allow("n", "hub_n", percent))
        .select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
    )
    to_hub = stored(_estimated(to_hub, contents, k), "neardup-candidates")

    # The full sets of all that stand in a list with another.
    listed = lists.select(F.col("rep").alias("_id")).distinct()
    sets = stored(_hashed(lean.join(listed, "_id").select("_id", "_text"), width, WHOLE_SET), "neardup-sets")
    same_text = named.join(contents.select("n", "s1", "s2", "rep"), ["n", "s1", "s2"]).select(
        F.col("rep").alias("a"), F.col("_id").alias("b")
    )
    links = stored(_confirmed(to_hub, sets, percent), "neardup-links")
    found = components(links)

    # Pairs of different components within a list.
    marked = stored(
        lists.filter("rank = 1").select("value", "rep", "n", "members", "hub")
        .join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep")),
        "neardup-marked",
    )
    mixed = marked.groupBy("value").agg(
        F.max(F.when(F.col("rep") == F.col("hub"), F.col("component"))).alias("hub_component"),
        F.min("component").alias("_low"), F.max("component").alias("_high"),
    ).filter("_low != _high")
    open_rows = marked.filter(F.col("members") > HUBS).join(mixed.select("value", "hub_component"), "value")
    open_ids = open_rows.select(F.col("rep").alias("_id")).distinct()
    single = sets.join(open_ids, "_id").select("_id", F.explode("hashes").alias("s")).distinct()
    twice = single.groupBy("s").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").select("s")
    shared = single.join(twice, "s").groupBy("_id").agg(F.count(F.lit(1)).alias("shared"))
    known = open_rows.join(shared.withColumnRenamed("_id", "rep"), "rep").filter(F.col("shared") * 100 >= percent * F.col("n"))
    placed = stored(_meeting(known.select("hub", "rep", "n", "component", "hub_component").distinct(), sets, percent), "neardup-meeting")
    for _ in range(ROUNDS):
        near = stored(_confirmed(_estimated(_nearest_pairs(placed, percent), contents, k), sets, percent), "neardup-links")
        placed = stored(_joined_components(placed, near), "neardup-meeting")
        links = links.unionByName(near)
    more = _confirmed(_estimated(_open_pairs(placed, percent), contents, k), sets, percent)

    ids = components(links.unionByName(more).unionByName(same_text.filter("a != b").distinct()))
    return sketches.join(ids, F.col("_id") == F.col("node"), "left").select(
        F.col("_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "_id") == F.col("_id"), F.lit(True)).alias("kept"),
    )

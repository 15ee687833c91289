"""Document fingerprints by a homomorphic multiset hash over paragraphs.

A paragraph (a ``\\n``-split line) is hashed into a wide vector: ``DIGESTS`` lanes that hold 32-bit digests of the
whole paragraph, ``LANES`` lanes that count, over its two-word shingles, one bit each of the shingle's 64-bit hash,
and one lane with the number of shingles. A document's fingerprint is the lane-wise sum over its paragraphs, modulo
2^32; no text that Spark can hold has 2^31 shingles, so its counts do not wrap. So the order of paragraphs does not matter, equal texts are equal, and paragraphs are inserted and
deleted by adding and subtracting their vectors, without reading the rest. The digests decide equality. The bit
counts, less half of the shingle count, are a random projection of the shingle counts: the cosine of two of them
estimates how much two texts share.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from machpulse.llm.text import SPACES, high_half, low_half, whole
from machpulse.sources.storage import stored

DIGESTS = 4
LANES = 64
SUMS = LANES // 2
DIGEST_POWER = 1 << 32
LANE_POWER = 1 << 32
#: One bit for lane j and one for lane j + 32, so that a long sums two lanes without carrying over.
TWO_LANES = 0x0000000100000001


def paragraph_sums(frame: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per key with the summed vector of its text's paragraphs: ``shingles, digests, lanes``.

    ``frame`` has one row per key. The rows of a text are summed where they are made; only sums are shuffled.
    """
    paragraphs = frame.select(*keys, F.explode(F.split(F.col(text), "\n", -1)).alias("_par")).select(
        *keys,
        *[F.xxhash64(F.lit(seed), "_par").alias(f"_h{seed}") for seed in range(DIGESTS // 2)],
        F.array_remove(F.split("_par", SPACES, -1), "").alias("_w"),
    )
    pairs = F.arrays_zip(F.col("_w").alias("a"), F.slice("_w", 2, F.greatest(F.size("_w"), F.lit(1))).alias("b"))
    shingles = paragraphs.select(*keys, "_h0", "_h1", F.posexplode_outer(pairs).alias("_pos", "_pair"))
    first = F.coalesce(F.col("_pos"), F.lit(0)) == 0
    hashed = shingles.select(
        *keys,
        *[F.when(first, part(F.col(f"_h{seed}"))).otherwise(0).alias(f"_d{2 * seed + k}")
          for seed in range(DIGESTS // 2) for k, part in enumerate((low_half, high_half))],
        F.when(F.col("_pos").isNotNull(), F.xxhash64("_pair")).alias("_shingle"),
    )
    bits = [F.shiftrightunsigned("_shingle", j).bitwiseAND(F.lit(TWO_LANES)) for j in range(SUMS)]
    sums = hashed.groupBy(*keys).agg(
        F.count("_shingle").alias("shingles"),
        *[F.sum(f"_d{i}").alias(f"_d{i}") for i in range(DIGESTS)],
        *[F.coalesce(F.sum(bit), F.lit(0)).alias(f"_b{j}") for j, bit in enumerate(bits)],
    )
    return sums.select(
        *keys,
        (F.col("shingles") % DIGEST_POWER).alias("shingles"),
        F.array(*[F.col(f"_d{i}") % DIGEST_POWER for i in range(DIGESTS)]).alias("digests"),
        F.array(
            *[low_half(F.col(f"_b{j}")) % LANE_POWER for j in range(SUMS)],
            *[high_half(F.col(f"_b{j}")) % LANE_POWER for j in range(SUMS)],
        ).alias("lanes"),
    )


def as_text(shingles, digests, lanes) -> Column:
    """The fingerprint in lowercase hex, eight digits for the shingle count, each digest and each lane."""
    def fixed(values) -> Column:
        return F.array_join(F.transform(values, lambda x: F.lpad(F.hex(x), 8, "0")), "")

    return F.lower(F.concat(F.lpad(F.hex(shingles), 8, "0"), fixed(digests), fixed(lanes)))


def likeness(n, lanes, other_n, other_lanes, same) -> Column:
    """Estimated cosine of two texts' shingle counts, from 0 to 1; exactly 1 for equal fingerprints."""
    def centred(values, count) -> Column:
        return F.transform(values, lambda x: _signed(2 * x - count).cast("double"))

    a, b = centred(lanes, n), centred(other_lanes, other_n)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x)) * F.sqrt(F.aggregate(b, F.lit(0.0), lambda s, x: s + x * x))
    cosine = F.when(norm > 0, dot / norm).otherwise(0.0)
    return F.when(same, 1.0).otherwise(F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine)), 6))


def _signed(value) -> Column:
    """The representative of a lane nearest to 0. Twice a count, less the shingles, is known modulo 2^32, as the
    shingles are; it is no larger than the number of shingles, so below 2^31."""
    half = F.lit(LANE_POWER // 2)
    return F.pmod(value + half, F.lit(LANE_POWER)) - half


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per input row: ``id, shingles, digests, lanes, fingerprint``. A null text is empty; an empty text is
    one empty paragraph. Repeated rows get equal fingerprints. Other columns are ignored."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), whole(text_col).alias("_text"))
    sums = paragraph_sums(rows, ["_row", "_id"], "_text")
    return sums.select(
        F.col("_id").alias(id_col), "shingles", "digests", "lanes", as_text("shingles", "digests", "lanes").alias("fingerprint")
    )


def combine(left: DataFrame, right: DataFrame, on: str, delete: bool = False) -> DataFrame:
    """Fingerprints after inserting (or deleting) the paragraphs that ``right`` was made of into those of ``left``."""
    sign = -1 if delete else 1
    r = right.select(F.col(on), F.col("shingles").alias("_n"), F.col("digests").alias("_d"), F.col("lanes").alias("_l"))
    both = left.select(on, "shingles", "digests", "lanes").join(r, on, "left")

    def moved(mine, theirs, power: int) -> Column:
        return F.when(F.col(theirs).isNull(), F.col(mine)).otherwise(
            F.zip_with(mine, theirs, lambda a, b: F.pmod(a + sign * b, F.lit(power)))
        )

    return both.select(
        on,
        F.pmod(F.col("shingles") + sign * F.coalesce("_n", F.lit(0)), F.lit(DIGEST_POWER)).alias("shingles"),
        moved("digests", "_d", DIGEST_POWER).alias("digests"),
        moved("lanes", "_l", LANE_POWER).alias("lanes"),
    ).withColumn("fingerprint", as_text("shingles", "digests", "lanes"))


def _followers(keys: DataFrame, key: list[str]) -> DataFrame:
    """Every key with the next lower one (for the lowest, the highest) in columns ``_next_...``, and its length.

    Keys are range-sorted and numbered by partition in a stored table; each partition looks up its own
    neighbours, and one row per partition carries them over the borders.
    """
    sliced = stored(
        keys.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("_slice", F.spark_partition_id()), "fingerprint-order"
    )
    me = F.struct(*key, "_n")
    own = Window.partitionBy("_slice").orderBy(*key)
    ends = sliced.groupBy("_slice").agg(F.max(me).alias("_top"))
    by_slice = Window.orderBy("_slice")
    ends = ends.select("_slice", F.coalesce(F.lag("_top").over(by_slice), F.max("_top").over(Window.partitionBy())).alias("_border"))
    near = sliced.withColumn("_before", F.lag(me).over(own)).join(F.broadcast(ends), "_slice")
    follower = F.coalesce("_before", "_border")
    return near.select(*key, "_n", "_copies", *[follower[c].alias(f"_next{c}") for c in [*key, "_n"]])


def edited(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Fingerprints of every text, of its edited form, and their likeness to each other and to the next text's.

    The next document is the next lower id (numbers by size, others by their text; null ids are lowest; equal ids go by a hash of the text; after the last
    comes the first). The last third of the code points is replaced by the first as many of the next text. Rows
    equal in id and text are one place in the order and come out as often as they came in. A null text is empty;
    a table of one document follows itself. Texts are shuffled once, their borrowed beginnings once.
    """
    key = ["_has", "_key", "_hash"]
    id_type = docs.schema[id_col].dataType
    ordered = id_type if isinstance(id_type, NumericType) else StringType()
    frame = docs.select(
        F.col(id_col).isNotNull().cast("int").alias("_has"),
        F.coalesce(F.col(id_col).cast(ordered), F.lit(0).cast(ordered)).alias("_key"),
        whole(text_col).alias("_text"),
    ).withColumn("_hash", F.xxhash64("_text"))
    keys = frame.select(*key, F.length("_text").cast("long").alias("_n")).groupBy(*key, "_n").agg(F.count(F.lit(1)).alias("_copies"))
    order = stored(_followers(keys, key), "fingerprint-followers")

    asked = order.select(*[F.col(f"_next{c}").alias(c) for c in key], *[F.col(c).alias(f"_for{c}") for c in key], F.floor(F.col("_n") / 3).cast("int").alias("_length"))
    known = order.join(asked, key).select(*key, "_n", "_copies", "_length", *[f"_for{c}" for c in key], *[f"_next{c}" for c in key])
    one = Window.partitionBy(*key).orderBy(*key)
    texts = frame.join(known, key).withColumn("_place", F.row_number().over(one)).filter("_place = 1")
    lent = texts.select(*[F.col(f"_for{c}").alias(c) for c in key], F.substring("_text", F.lit(1), F.col("_length")).alias("_lent"))
    changed = texts.drop("_length").join(lent, key).select(
        *key, "_n", "_copies", *[f"_next{c}" for c in key], F.col("_text").alias("_own"),
        F.concat(F.substring("_text", F.lit(1), (F.col("_n") - F.floor(F.col("_n") / 3)).cast("int")), "_lent").alias("_changed"),
    )
    facts = [*key, "_n", "_copies", *[f"_next{c}" for c in key]]
    sides = changed.select(
        *facts,
        F.explode(F.array(
            F.struct(F.lit(0).alias("side"), F.col("_own").alias("text"), F.lit(None).cast("string").alias("sha")),
            F.struct(F.lit(1).alias("side"), F.col("_changed").alias("text"), F.sha2("_changed", 256).alias("sha")),
        )).alias("_s"),
    ).select(*facts, F.col("_s.side").alias("_side"), F.col("_s.sha").alias("_sha"), F.col("_s.text").alias("_t"))
    sums = paragraph_sums(sides, [*facts, "_side", "_sha"], "_t")
    vector = F.struct("_sha", "shingles", "digests", "lanes")
    per_doc = sums.groupBy(*facts).agg(
        F.max(F.when(F.col("_side") == 0, vector)).alias("a"), F.max(F.when(F.col("_side") == 1, vector)).alias("b")
    )
    per_doc = stored(per_doc, "fingerprint-vectors")
    nexts = per_doc.select(*[F.col(c).alias(f"_next{c}") for c in key], F.col("a").alias("c"))
    full = per_doc.join(nexts, [f"_next{c}" for c in key])

    def same(x: str, y: str) -> Column:
        return (F.col(f"{x}.shingles") == F.col(f"{y}.shingles")) & (F.col(f"{x}.digests") == F.col(f"{y}.digests")) & (F.col(f"{x}.lanes") == F.col(f"{y}.lanes"))

    def like(x: str, y: str) -> Column:
        return likeness(F.col(f"{x}.shingles"), F.col(f"{x}.lanes"), F.col(f"{y}.shingles"), F.col(f"{y}.lanes"), same(x, y))

    result = full.select(
        F.when(F.col("_has") == 1, F.col("_key").cast(id_type)).alias(id_col),
        F.col("_n").alias("n_chars"),
        F.col("b._sha").alias("edited_sha256"),
        as_text("a.shingles", "a.digests", "a.lanes").alias("fingerprint"),
        as_text("b.shingles", "b.digests", "b.lanes").alias("edited_fingerprint"),
        like("a", "b").alias("near_edited"),
        like("a", "c").alias("near_next"),
        F.when(F.col("_next_has") == 1, F.col("_next_key").cast(id_type)).alias("next_id"),
        "_copies",
    )
    # One output row for each repeated input row.
    return result.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).drop("_copy", "_copies")

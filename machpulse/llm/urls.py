"""URL filters: host and path rules, and a Bloom filter cascade over a list of blocked domains.

Level 0 of the cascade encodes the listed keys. The keys of the corpus that pass it wrongly are encoded in level 1,
the listed keys that pass level 1 wrongly in level 2, and so on until nobody passes wrongly. Over that key universe
the answer is exact: the first level that a key does not pass decides. Level 0 is sized so that about as many other
keys pass as are listed (``n * log2(universe / n)`` bits or so), so every level is bounded by the list, whatever the
corpus. A lookup reads literal bytes; nothing is joined. A list whose cascade would exceed ``MAX_FILTER_BYTES`` is
parted by the hash of its keys; the urls are then judged part by part, each with a cascade of its own within the bound.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from machpulse.sources.storage import stored

MAX_FILTER_BYTES = 64 << 20
LATER_RATE = 1 / 16


def host_of(url) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def domains(host, depth: int) -> Column:
    """The host and its parent domains of at most ``depth`` labels; longer ones cannot equal a listed key."""
    labels = F.split(host, r"\.", -1)
    last = F.slice(labels, F.greatest(F.size(labels) - depth + 1, F.lit(1)), depth)
    every = F.transform(last, lambda _, i: F.array_join(F.slice(last, i + 1, depth), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(every)


class Level:
    """One Bloom filter: its bytes as a literal, its number of hash functions and its seed."""

    def __init__(self, seed: int, bits: int, hashes: int, data: bytes):
        self.seed, self.bits, self.hashes, self.data = seed, bits, hashes, data

    @staticmethod
    def position(seed: int, turn: int, key, bits: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), key), F.lit(bits))

    def passes(self, key) -> Column:
        table = F.lit(self.data)
        found = F.lit(True)
        for turn in range(self.hashes):
            place = self.position(self.seed, turn, key, self.bits)
            byte = F.conv(F.hex(F.substring(table, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            found = found & (F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1)
        return found


def _level(keys: DataFrame, count: int, rate: float, seed: int, budget: int) -> Level:
    hashes = max(1, math.ceil(-math.log2(rate)))
    bits = max(64, 8 * math.ceil(count * hashes / math.log(2) / 8))
    if bits // 8 > budget:
        raise ValueError(f"a filter of {bits // 8} bytes is over the bound of the cascade")
    places = F.array(*[Level.position(seed, turn, F.col("key"), bits) for turn in range(hashes)])
    filled = (
        keys.select(F.explode(places).alias("p"))
        .groupBy((F.col("p") / 8).cast("int").alias("byte"))
        .agg(F.bit_or(F.pow(F.lit(2), F.pmod("p", F.lit(8))).cast("int")).alias("value"))
    )
    data = bytearray(bits // 8)
    for row in filled.toLocalIterator():  # at most one row per byte of a filter whose size was checked
        data[row["byte"]] = row["value"]
    return Level(seed, bits, hashes, bytes(data))


class Cascade:
    def __init__(self, levels: list[Level]):
        self.levels = levels

    def listed(self, key) -> Column:
        """Whether a key of the universe is on the list."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for number in reversed(range(len(self.levels))):
            answer = F.when(self.levels[number].passes(key), answer).otherwise(F.lit(number % 2 == 1))
        return answer


def _told_apart(listed: DataFrame, universe: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct listed keys, and the other keys of the universe; null ones are ignored."""
    yes = stored(listed.filter("key IS NOT NULL").distinct(), "cascade-listed")
    return yes, stored(universe.filter("key IS NOT NULL").distinct().join(yes, "key", "left_anti"), "cascade-universe")


def _first_rate(count: int, others: int) -> float:
    return min(0.5, count / (math.sqrt(2) * max(others, 1))) if count else 0.5


def parts_needed(count: int, others: int, max_bytes: int) -> int:
    """Parts of a list of ``count`` keys, so that the cascade of each is within the bound.

    A key takes its bits in level 0 and less than a byte in all later ones; a quarter is left for uneven parts.
    """
    a_key = math.ceil(-math.log2(_first_rate(count, others))) / math.log(2) / 8 + 1
    return max(1, math.ceil(1.25 * count * a_key / max_bytes))


def _cascade(yes: DataFrame, no: DataFrame, max_bytes: int) -> Cascade:
    count, others = yes.count(), no.count()
    levels: list[Level] = []
    rate, left = _first_rate(count, others), max_bytes
    while count:
        level = _level(yes, count, rate, len(levels), left)
        levels.append(level)
        left -= len(level.data)
        wrong = stored(no.filter(level.passes(F.col("key"))), "cascade-level")
        yes, no, count, rate = wrong, yes, wrong.count(), LATER_RATE
    return Cascade(levels)


def build_cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> Cascade:
    """Cascade of ``listed`` (one column ``key``) that is exact for all of ``universe`` (one column ``key``).

    Null keys are ignored, repeated ones count once. An empty list gives a cascade that lists nothing.
    """
    return _cascade(*_told_apart(listed, universe), max_bytes)


def _fits(host, path, rule: str) -> Column:
    domain, slash, rest = rule.partition("/")
    return ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: tuple[tuple[str, str], ...], id_col="page_id", url_col="url", depth: int = 8,
    max_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """One row per input row: ``id, host, path, rule, verdict, listed``.

    ``rules`` are (``block`` or ``allow``, ``host/path``); the longest that fits decides. Without one, a url is blocked
    if its host or a parent domain is in ``listed`` (column ``key``); hosts are looked up as deep as the longest key, ``depth`` labels at least. A null or
    relative url has no host and is allowed. Repeated rows and ties are judged alike; other columns are ignored.
    """
    parsed = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    longest = listed.agg(F.max(F.size(F.split("key", r"\.")))).first()[0]
    depth = max(depth, longest or 0)
    universe = parsed.select("host").distinct().select(F.explode(domains(F.col("host"), depth)).alias("key"))
    yes, no = _told_apart(listed, universe)
    parts = parts_needed(yes.count(), no.count(), max_bytes)

    def known_in(part: int) -> Column:
        def mine(key):
            return F.pmod(F.xxhash64(F.lit("part"), key), F.lit(parts)) == part

        cascade = _cascade(*[keys.filter(mine(F.col("key"))) if parts > 1 else keys for keys in (yes, no)], max_bytes)
        return F.exists(
            domains(F.col("host"), depth), lambda key: mine(key) & cascade.listed(key) if parts > 1 else cascade.listed(key)
        )

    if parts == 1:
        known = known_in(0)
    else:
        known = F.col("_known")
        parsed = parsed.withColumn("_known", F.lit(False))
        for part in range(parts):
            parsed = stored(parsed.withColumn("_known", known | known_in(part)), "urls-judged")
    rule = F.lit(None).cast("string")
    verdict = F.when(known, F.lit("block")).otherwise(F.lit("allow"))
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        fits = _fits(F.col("host"), F.col("path"), text)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return parsed.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("verdict"), known.alias("listed"))

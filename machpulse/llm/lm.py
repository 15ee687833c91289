"""Language-model scores by a weighted backoff automaton.

States are the n-grams of the training texts up to ``order - 1`` words, arcs their continuations. With C the count of a
state and c that of an arc, the arc weighs ``(c + K * p) / (C + K)`` where p is the weight of the word one state
lower; a word without an arc takes the failure arc, which weighs ``K / (C + K)``, to the state one word shorter. The
root weighs words as the base does and has mass for unknown ones, so every state's weights sum to one. A text is
read once from left to right (``traverse``): the state carried is the longest known n-gram that ends before the word;
failure arcs are followed until the state has an arc for the word, and the logarithms of both add up.

The automaton grows with the corpus, so no task holds it. Texts are hashed into blocks of about ``BLOCK_BYTES``; a
block sends each of its distinct n-grams once, with its count in training texts, to the range of hashes that sums
them; back come the totals in the order sent, which is just the part of the automaton that the block can reach.
Frequent n-grams are one entry per block, whatever their share of the corpus.

There are as many ranges as blocks, so that neither outgrows a task. A sender has at most ``FAN_OUT`` receivers:
beyond as many blocks the n-grams go over several hops. A hop parts the ranges further and merges as many senders as
it parts them into, so each hop has about as many tasks as there are blocks, each with about a block's n-grams, and
the messages of a hop grow in proportion to the corpus. The totals come back by the same hops.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from machpulse.llm.text import whole

BLOCK_BYTES = 8 << 20
FAN_OUT = 4096
ORDER = 2
STRENGTH = 128.0
BASE = 0.1


def _constants():
    import numpy as np

    from machpulse.llm.arrays import _FACTOR, mix

    begin, end = mix(np.array([11, 12], np.uint64))
    return begin, end, _FACTOR[20:], mix


def block_grams(table, order: int):
    """Of the texts of a block: token numbers per text, and for k = 1..order the hash of the k-gram that ends at each place.

    A text's places are a beginning, its words and an end. A gram that would reach before the beginning is hash 0.
    """
    import numpy as np

    from machpulse.llm.arrays import word_hashes

    begin, end, factors, mix = _constants()
    parts, sizes = [], []
    for chunk in table.column("_text").chunks:
        for words in word_hashes(chunk):
            parts += [np.array([begin], np.uint64), words, np.array([end], np.uint64)]
            sizes.append(len(words) + 2)
    tokens = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    sizes = np.array(sizes, np.int64)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(tokens)) - np.repeat(starts, sizes)
    grams = []
    for k in range(1, order + 1):
        total = np.full(len(tokens), np.uint64(k), np.uint64)
        for back in range(k):
            total[back:] += tokens[: len(tokens) - back] * factors[back]
        hashed = mix(total)
        hashed[hashed == 0] = 1
        hashed[place < k - 1] = 0
        grams.append(hashed)
    return tokens, sizes, starts, grams


MESSAGES = "_group long, _part long, _sender long, _keys binary, _counts binary"
REPLIES = "_group long, _part long, _from long, _totals binary"


def hops(blocks: int, fan_out: int) -> list[int]:
    """Receivers of a sender at each hop, as many as senders of a receiver; with all hops every block reaches every range."""
    fans = [min(blocks, fan_out)]
    while (blocks := -(-blocks // fan_out)) > 1:
        fans.append(min(blocks, fan_out))
    return fans


def _bytes(values) -> bytes:
    """Bytes of one rank together: sorted hashes share their upper ones, which then compress."""
    import numpy as np

    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _messages(keys, counts, sender: int, part: int, parts: int, fan: int):
    """The sorted keys of a sender, which has hash range ``part`` of ``parts``, to ``fan`` parts of this range."""
    import numpy as np
    import pyarrow as pa

    edges = np.array([((part * fan + r) << 64) // (parts * fan) for r in range(1, fan)], np.uint64)
    cuts = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
    full = np.flatnonzero(np.diff(cuts))
    return pa.table({
        "_group": pa.array(np.full(len(full), sender // fan, np.int64)),
        "_part": pa.array(part * fan + full),
        "_sender": pa.array(np.full(len(full), sender, np.int64)),
        "_keys": pa.array([_bytes(keys[cuts[r]: cuts[r + 1]]) for r in full], pa.binary()),
        "_counts": pa.array([_bytes(counts[cuts[r]: cuts[r + 1]]) for r in full], pa.binary()),
    })


def _train(table):
    import numpy as np

    return ~np.asarray(table.column("_held").to_numpy(zero_copy_only=False), bool)


def _send(order: int, fan: int):
    def run(key, table):
        import numpy as np

        _, sizes, _, grams = block_grams(table, order)
        learn = np.repeat(_train(table), sizes)
        keys, number = np.unique(np.concatenate(grams), return_inverse=True)
        counts = np.bincount(number, weights=np.tile(learn, order), minlength=len(keys)).astype(np.uint32)
        return _messages(keys, counts, key[0].as_py(), 0, 1, fan)

    return run


def _unpack(data: bytes, kind):
    import numpy as np

    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def _received(table):
    """Distinct keys of the messages to one receiver, the number of each key sent, and where the messages part."""
    import numpy as np

    keys = [_unpack(k, np.uint64) for k in table.column("_keys").to_pylist()]
    distinct, number = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, number, np.cumsum([len(k) for k in keys])[:-1]


def _summed(table, number, size: int, kind):
    import numpy as np

    counts = np.concatenate([_unpack(c, kind) for c in table.column("_counts").to_pylist()])
    return np.bincount(number, weights=counts, minlength=size).astype(np.uint64)


def _answer(key, table, totals, cuts, fan: int):
    """To each sender of the messages: the totals in the order of its keys."""
    import numpy as np
    import pyarrow as pa

    rows, part = table.num_rows, key[1].as_py()
    return pa.table({
        "_group": table.column("_sender"),
        "_part": pa.array(np.full(rows, part // fan, np.int64)),
        "_from": pa.array(np.full(rows, part, np.int64)),
        "_totals": pa.array([_bytes(t) for t in np.split(totals, cuts)], pa.binary()),
    })


def _in_order(replies):
    """The totals of all receivers of a sender, in the order of its keys."""
    import numpy as np

    sent = replies.column("_totals").to_pylist()
    return np.concatenate([_unpack(sent[i], np.uint64) for i in np.argsort(replies.column("_from").to_numpy())])


def _add(fan: int, kind: str):
    def run(key, table):
        distinct, number, cuts = _received(table)
        return _answer(key, table, _summed(table, number, len(distinct), kind)[number], cuts, fan)

    return run


def _pass_on(parts: int, fan: int, kind: str):
    def run(key, table):
        distinct, number, _ = _received(table)
        counts = _summed(table, number, len(distinct), kind)
        return _messages(distinct, counts, key[0].as_py(), key[1].as_py(), parts, fan)

    return run


def _pass_back(fan: int):
    def run(key, table, replies):
        _, number, cuts = _received(table)
        return _answer(key, table, _in_order(replies)[number], cuts, fan)

    return run


def _totals(sent: DataFrame, fans: list[int], parts: int = 1, kind: str = "u4") -> DataFrame:
    """Replies to the senders of ``sent``; ``parts`` is the number of hash ranges before this hop."""
    nodes, parts = sent.groupBy("_group", "_part"), parts * fans[0]
    if len(fans) == 1:
        return nodes.applyInArrow(_add(fans[0], kind), REPLIES)
    passed = nodes.applyInArrow(_pass_on(parts, fans[1], kind), MESSAGES)
    back = _totals(passed, fans[1:], parts, "u8").groupBy("_group", "_part")
    return nodes.cogroup(back).applyInArrow(_pass_back(fans[0]), REPLIES)


def automaton(count, base, strength: float):
    """Arcs, failure arcs and known states at every place of a block, from the counts of the n-grams that end there.

    ``arcs[k]``: log10 weight of the arc that reads the place's word in the state of the k words before; -inf without such an
    arc. ``fails[k]``: log10 weight of the failure arc of that state. ``known[k]``: whether the place's last k words are a state.
    """
    import numpy as np

    order, places = count.shape
    arcs, fails = np.full((order, places), -np.inf), np.zeros((order, places))
    known = np.ones((order, places), bool)
    known[1:] = count[: order - 1] > 0
    arcs[0] = weight = np.log10(base)
    for k in range(1, order):
        state = np.append(0.0, count[k - 1][:-1])  # the k-gram that ends before the word
        there = count[k] > 0
        fails[k] = np.log10(strength / (state + strength))
        arcs[k][there] = np.log10((count[k][there] + strength * 10.0 ** weight[there]) / (state[there] + strength))
        weight = np.where(there, arcs[k], fails[k] + weight)
    return arcs, fails, known


def traverse(arcs, fails, known, starts, sizes):
    """Log10 probability of each text: all are read side by side, one word at a time, each with its own state."""
    import numpy as np

    order = len(arcs)
    longest_first = np.argsort(-sizes, kind="stable")
    begin, left = starts[longest_first], sizes[longest_first]
    total = np.zeros(len(starts))
    # After the beginning, the state is the beginning itself where training texts had one.
    state = np.where(known[1, begin], 1, 0) if order > 1 else np.zeros(len(starts), np.int64)
    for step in range(1, int(left.max(initial=0))):
        active = int(np.searchsorted(-left, -step, "left"))
        at, k, sums = begin[:active] + step, state[:active], total[:active]
        while True:
            stuck = np.flatnonzero(np.isneginf(arcs[k, at]))
            if not len(stuck):
                break
            sums[stuck] += fails[k[stuck], at[stuck]]
            k[stuck] -= 1
        sums += arcs[k, at]
        longer = np.minimum(k + 1, order - 1)
        state[:active] = np.where(known[longer, at], longer, 0)
    out = np.empty(len(starts))
    out[longest_first] = total
    return out


def _score(order: int, tokens_all: int, types: int, strength: float, id_type):
    def run(key, table, replies):
        import numpy as np
        import pyarrow as pa

        rows = table.num_rows
        if not rows:
            return pa.table({"_id": pa.array([], id_type), **{n: pa.array([], t) for n, t in _TYPES}})
        tokens, sizes, starts, grams = block_grams(table, order)
        keys, number = np.unique(np.concatenate(grams), return_inverse=True)
        totals = _in_order(replies).astype(np.float64)
        totals[keys == 0] = 0.0
        count = totals[number].reshape(order, -1)
        del tokens, grams, keys, number, totals
        base = (count[0] + BASE) / (tokens_all + BASE * (types + 1))
        read = np.ones(count.shape[1], bool)
        read[starts] = False

        def per_text(values):
            return np.add.reduceat(np.where(read, values, 0.0), starts)

        return pa.table({
            "_id": table.column("_id"),
            "held_out": table.column("_held"),
            "n_tokens": pa.array(sizes - 1, pa.int64()),
            "n_known": pa.array(per_text(count[0] > 0).astype(np.int64)),
            "train_tokens": pa.array(np.full(rows, tokens_all, np.int64)),
            "base_score": pa.array(per_text(np.log10(base))),
            "score": pa.array(traverse(*automaton(count, base, strength), starts, sizes)),
        })

    import pyarrow as pa

    _TYPES = (("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
              ("base_score", pa.float64()), ("score", pa.float64()))
    return run


def _unigrams(batches):
    """(token, count) of the training texts of a batch."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        table = pa.Table.from_batches([batch])
        tokens, sizes, starts, _ = block_grams(table, 1)
        learn = np.repeat(_train(table), sizes)
        learn[starts] = False
        found, counts = np.unique(tokens[learn], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], names=["token", "count"])


def block_of(blocks: int, *columns):
    """Block of a row. The partition it is read in parts equal rows; unlike a row number it is the same in a rerun."""
    return F.pmod(F.xxhash64(*columns, F.spark_partition_id()), F.lit(blocks))


def score(
    docs: DataFrame, id_col="doc_id", text_col="text", order: int = ORDER, strength: float = STRENGTH,
    block_bytes: int = BLOCK_BYTES, fan_out: int = FAN_OUT,
) -> DataFrame:
    """One row per input row: ``id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Texts whose ``crc32`` of the id as text is divisible by 10 are held out (a null id counts as the empty text), the
    others are learned from. Tokens are the words, A-Z as a-z, then one end; a null or empty text is the end alone.
    ``base_score`` is the log10 probability by the smoothed unigrams, ``score`` that of the automaton. Repeated rows
    count each; those equal in id and text are dealt to blocks by the partition they are read in, so a block holds at
    most a partition's. Without training texts both scores are those of the empty model. Other columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    lean = docs.select(
        F.col(id_col).alias("_id"), whole(text_col).alias("_text"),
        (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 10 == 0).alias("_held"),
    )
    facts = lean.select("_text", "_held").mapInArrow(_unigrams, "token long, count long").groupBy("token").agg(F.sum("count").alias("c"))
    size, model = lean.agg(F.sum(F.octet_length("_text") + 16)).first()[0] or 0, facts.agg(F.count("token"), F.sum("c")).first()
    types, tokens = model[0], model[1] or 0
    blocks = max(1, -(-size // block_bytes))
    parted = lean.withColumn("_block", block_of(blocks, "_id", "_text"))
    fans = hops(blocks, fan_out)
    sent = parted.groupBy("_block").applyInArrow(_send(order, fans[0]), MESSAGES)
    totals = _totals(sent, fans)
    id_type = lean.schema["_id"].dataType
    schema = docs.select(
        F.col(id_col).alias("_id"), F.lit(True).alias("held_out"), F.lit(0).cast("long").alias("n_tokens"),
        F.lit(0).cast("long").alias("n_known"), F.lit(0).cast("long").alias("train_tokens"), F.lit(0.0).alias("base_score"),
        F.lit(0.0).alias("score"),
    ).schema
    scored = parted.groupBy("_block").cogroup(totals.groupBy("_group")).applyInArrow(
        _score(order, tokens, types, strength, to_arrow_type(id_type)), schema
    )
    return scored.withColumnRenamed("_id", id_col)

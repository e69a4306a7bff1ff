"""Hierarchical Pitman-Yor bigram model, trained and applied as Spark jobs.

Teh, "A Hierarchical Bayesian Language Model based on Pitman-Yor Processes" (2006).
A word is drawn from the restaurant of its context, the word before it; every
context word has a restaurant of its own. All of them share one parent, the unigram
restaurant, whose base is uniform over the known words and one unknown word. A
customer of a context restaurant sits at a table that serves its word or opens one
by sending a customer to the parent.

Seating is sampled by Gibbs sweeps: the customers of one word in one restaurant are
seated anew, one group after another, given the seating of everything else. A group
is a single customer up to GROUP customers, and 1 / GROUP of those seated beyond,
so the work of a frequent pair grows with the logarithm of its count. Probabilities
are averaged over the last two samples, each with its own tables, customers and root,
so those of a context sum to 1 over the known words and one unknown word.

How it is spread: words are dealt into buckets of about BUCKET_TOKENS tokens by their
hash, the most frequent ones by word and context. Documents stay together in chunks of
about CHUNK_TOKENS tokens. A chunk asks every bucket for the pairs it has of it, each
once and with its training count, and keeps which document has a pair how often; so a
pair adds one number a chunk to its bucket, however frequent it is. A bucket is one row
of packed numbers: its pairs with their counts, and who asks for them.

Buckets are sampled independently given the tables and customers of the restaurants.
These are a Spark table of one row per bucket and context: after every round it is
summed up by context, and the sums meet the pairs of their bucket in the next one. The
seating of a round is not kept: it follows from the sums before it and a seed, so the
last step draws the last two samples again and takes their sums from the table. At the
end a bucket answers each chunk, which sums up the scores of its documents.

Words that are more than 1 / FREQUENT of all tokens (so FREQUENT of them at most) are
written as their rank instead of their hash, to save room; nothing else depends on it.
What reaches the driver are totals, these words, and those so frequent that they are
dealt by context, HOT_SHARE a bucket at most.

Defined results: a null text is an empty one and has the end token only. Documents
without an id are scored, not learned from, and not held out. Repeated rows are
learned from and scored each. Without training documents every token is unknown and
has the probability of the base. Words and contexts are compared by a 64-bit hash.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import column_bytes, discard, id_fold, ship, stored

RESTAURANTS = 1 << 18  # restaurants in one batch of the first seating
DISCOUNT, STRENGTH = 0.75, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 1.0
GROUP = 32
ROUNDS, SWEEPS = 3, 2  # the last two rounds are the samples
CHUNK_TOKENS = 1_000_000
BUCKET_TOKENS = 2_000_000
FREQUENT = 1 << 20
HOT_SHARE = 4  # a word with over BUCKET_TOKENS / HOT_SHARE tokens is dealt by context
END = np.uint64(0x5D3A4E8B1F6C2907)
START = np.uint64(0x27C1B0A94D85E3F6)
HASH_SEED = 42


class WordNumbers:
    """Hashes of words to their numbers: the rank of a frequent word, else its hash.

    ``names`` are the hashes of frequent words, ``ranks`` their ranks.
    """

    def __init__(self, names: np.ndarray, ranks: np.ndarray):
        self.names, self.ranks = names, ranks
        order = np.argsort(names)
        self.known, self.rank = names[order], ranks[order]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return hashes
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.rank[at], hashes)

    def number(self, value: int) -> int:
        return int(self.of(np.array([value], dtype=np.uint64))[0])


def coded_texts(texts: list[bytes | None], numbers: WordNumbers | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, or numbers, of the distinct words and of the end; the positions of all
    tokens among them, text after text; how many tokens each text has.

    Words are told apart by Arrow, so that only distinct ones become Python objects. The
    first array may hold a word that does not occur.
    """
    lowered = pa.array([(t or b"").lower() for t in texts], pa.large_binary()).view(pa.large_string())
    lists = pc.ascii_split_whitespace(lowered)  # with empty words at the edges
    words = lists.flatten().dictionary_encode()
    distinct = words.dictionary.cast(pa.large_binary())
    spelled = distinct.to_numpy(zero_copy_only=False)
    names = np.fromiter(chain(map(xxhash.xxh64_intdigest, spelled, repeat(HASH_SEED)), [int(END)]), np.uint64, len(spelled) + 1)
    at, length = words.indices.to_numpy(), pc.list_value_length(lists).to_numpy()
    real = pc.binary_length(distinct).to_numpy()[at] > 0
    before, stop = np.concatenate([[0], np.cumsum(real)]), np.cumsum(length)
    size = before[stop] - before[stop - length] + 1
    code = np.full(int(size.sum()), len(spelled), dtype=np.int64)
    no_end = np.ones(len(code), dtype=bool)
    no_end[np.cumsum(size) - 1] = False
    code[no_end] = at[real]
    return names if numbers is None else numbers.of(names), code, size


def tokens(text: bytes | None, numbers: WordNumbers | None = None) -> np.ndarray:
    """Hashes, or numbers, of the words of a text and of the end."""
    names, code, _ = coded_texts([text], numbers)
    return names[code]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x7FB5D329728EA185)
    return x ^ x >> np.uint64(29)


def contexts(words: np.ndarray) -> np.ndarray:
    """The token before, of every token of a document."""
    return np.concatenate([np.array([START], dtype=np.uint64), words[:-1]])


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as compressed bytes, bytes of equal weight side by side."""
    parts = [struct.pack("<H", len(arrays))]
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T
        parts += [struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)), planes.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 2
    for _ in range(struct.unpack_from("<H", raw)[0]):
        kind, n = struct.unpack_from("<2sQ", raw, at)
        dtype = np.dtype("<" + kind.decode())
        planes = np.frombuffer(raw, np.uint8, n * dtype.itemsize, at + 10).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(dtype).ravel())
        at += 10 + n * dtype.itemsize
    return out


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, in sorted arrays."""
    new = np.zeros(len(keys[0]), dtype=bool)
    if len(new):
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in their order, and the position of every value among them; only the distinct ones are sorted."""
    found = pa.array(values).dictionary_encode()
    names = found.dictionary.to_numpy()
    order = np.argsort(names)
    place = np.empty(len(names), dtype=np.int64)
    place[order] = np.arange(len(names))
    return names[order], place[found.indices.to_numpy()]


def entries_of(pair: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (pair, document) in order, and how often each occurs; ``docs`` is above all documents."""
    if (int(pair.max(initial=0)) + 1) * docs < 1 << 63:  # one number to sort, unless a single text is enormous
        both = pair * docs + doc
        both.sort()
        entry = runs(both)
        times, both = np.diff(entry, append=len(both)), both[entry]
        pair = both // docs
        return pair, both - pair * docs, times
    order = np.lexsort((doc, pair))
    pair, doc = pair[order], doc[order]
    entry = runs(pair, doc)
    return pair[entry], doc[entry].astype(np.int64), np.diff(entry, append=len(pair))


def kept(df: DataFrame, name: str) -> DataFrame:
    """stored(), whose shuffle files go when it is written: nothing reads them again."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return stored(df, name)
    finally:
        conf.set(key, before)


# --- unigrams ---------------------------------------------------------------------

def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c, n): how often in the training rows, and in all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, train = column_bytes(batch, "text"), np.asarray(batch.column(0).to_pylist(), dtype=bool)
            for part in chunks(texts):
                words, code, size = coded_texts([texts[i] for i in part])
                n, c = (np.bincount(x, minlength=len(words)) for x in (code, code[np.repeat(train[part], size)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[n > 0]) for x in (words.view(np.int64), c, n)], ["word", "c", "n"])

    return (rows.select("train", "text").mapInArrow(count, "word long, c long, n long")
            .groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")))


def chunks(texts: list[bytes | None]) -> Iterator[list[int]]:
    """Positions of consecutive texts of about CHUNK_TOKENS tokens."""
    part, size = [], 0
    for i, t in enumerate(texts):
        part.append(i)
        size += len(t or b"") // 6 + 1
        if size >= CHUNK_TOKENS:
            yield part
            part, size = [], 0
    if part:
        yield part


# --- buckets ----------------------------------------------------------------------

def bucket_count(n_tokens: int) -> int:
    """Buckets for a corpus: by its tokens, whatever the cores and the shuffle partitions."""
    return max(1, -(-n_tokens // BUCKET_TOKENS))


NO_WORDS = np.empty(0, dtype=np.uint64)


def dealt(rows: DataFrame, hot: np.ndarray, buckets: int, names: np.ndarray = NO_WORDS, ranks: np.ndarray = NO_WORDS) -> DataFrame:
    """(bucket, chunk, part): what a chunk of documents asks a bucket, and what it keeps.

    A question holds, sorted by word and context: words with their numbers of pairs,
    contexts and training counts. What a chunk keeps (bucket < 0) are its pairs in the
    order of the questions with their numbers of entries, the entries (document, count),
    and the documents (id, flags). ``hot`` are numbers of words.
    """
    sent = rows.sparkSession.sparkContext.broadcast((names, ranks))  # FREQUENT words at most

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = WordNumbers(*sent.value)
        for batch in batches:
            texts = column_bytes(batch, "text")
            row, doc_id = batch.column(0).to_numpy(), batch.column(1)
            ids = doc_id.fill_null(0).to_numpy()
            flags = np.asarray(batch.column(2).to_pylist(), dtype=np.uint8) + 2 * np.asarray(doc_id.is_null().to_pylist(), dtype=np.uint8)
            for part in chunks(texts):
                names, code, size = coded_texts([texts[i] for i in part], numbers)
                names, place = coded(names)
                word, docs = place[code], len(size)
                context = np.concatenate([[0], word[:-1]])  # positions in names, which ends with START
                context[np.cumsum(size) - size] = len(names)
                key = word * (len(names) + 1) + context
                names = np.append(names, START)
                key, doc, times = entries_of(key, np.repeat(np.arange(docs), size), docs)
                del code, word, context
                pair = runs(key)
                per_pair = np.diff(pair, append=len(key))
                word, context = np.divmod(key[pair], len(names))  # once a pair, and what words alone tell, once a word
                place, many = mix(names)[word], np.isin(names, hot)[word]
                place[many] = mix(place[many] + names[context[many]])
                bucket = ((place >> np.uint64(16)) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int32)
                order = np.argsort(bucket, kind="stable")  # by counting, with 16 bits
                word, context, bucket = names[word[order]], names[context[order]], bucket[order].astype(np.int32)
                per_pair = per_pair[order]
                start = np.cumsum(per_pair) - per_pair
                entry = np.repeat(pair[order] - start, per_pair) + np.arange(len(key))
                doc, times = doc[entry].astype(np.uint32), times[entry]
                learned = np.add.reduceat(times * (flags[part][doc] & 1), start)
                per_pair = per_pair.astype(np.uint32)
                edges = runs(bucket)
                out = []
                for a, b in zip(edges, [*edges[1:], len(bucket)]):
                    first = runs(word[a:b])
                    out.append(pack(word[a:b][first], np.diff(first, append=b - a).astype(np.uint32), context[a:b], learned[a:b]))
                out.append(pack(per_pair, doc, times.astype(np.uint32), ids[part], flags[part]))
                chunk = int(row[part[0]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*bucket[edges].tolist(), -1 - (chunk ^ chunk >> 33) % buckets], pa.int32()),
                     pa.array([chunk] * len(out), pa.int64()), pa.array(out, pa.binary())], ["bucket", "chunk", "part"])

    return rows.select("row", "doc_id", "train", "text").mapInArrow(deal, "bucket int, chunk long, part binary")


def merged(parts: list[bytes]) -> tuple[np.ndarray, ...]:
    """One bucket: pairs (word, context, training count), the pair of every question, and the sizes of the parts."""
    words, per_word, contexts_, counts = zip(*map(unpack, parts))
    sizes = np.array([len(c) for c in contexts_])
    names, word = coded(np.concatenate(words))
    before, context = coded(np.concatenate(contexts_))
    key = np.repeat(word, np.concatenate(per_word)) * len(before) + context
    count = np.concatenate(counts)
    del words, per_word, contexts_, counts, word, context
    order = np.argsort(key)
    key, count = key[order], count[order]
    start = runs(key)
    of = np.empty(len(order), dtype=np.uint32)
    of[order] = np.repeat(np.arange(len(start), dtype=np.uint32), np.diff(start, append=len(key)))
    word, context = np.divmod(key[start], len(before))
    return names[word], before[context], np.add.reduceat(count, start), of, sizes


def packed_pairs(word: np.ndarray, context: np.ndarray, count: np.ndarray) -> bytes:
    """Pairs sorted by word: words, their numbers of pairs, contexts, positions of these, counts."""
    first = runs(word)
    names, at = coded(context)
    steps = np.diff(names, prepend=names[:1] * 0)
    return pack(word[first], np.diff(first, append=len(word)).astype(np.uint32), steps, at.astype(np.uint32), count)


def unpacked_pairs(data: bytes) -> tuple[np.ndarray, ...]:
    """(words, distinct contexts, position of the context, count)."""
    word, per_word, steps, at, count = unpack(data)
    return np.repeat(word, per_word), np.cumsum(steps, dtype=np.uint64), at, count


def bucket_rows(parts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, pairs, asks, entries): a row per bucket, and one per chunk with its entries."""

    def row(b: int, chunk: int | None, *data: bytes | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([b], pa.int32()), pa.array([chunk], pa.int64()), *(pa.array([d], pa.binary()) for d in data)],
            ["bucket", "chunk", "pairs", "asks", "entries"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            for b, chunk, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if b < 0:
                    yield row(b, chunk, None, None, part)
                else:
                    held.setdefault(b, []).append((chunk, part))
        for b in list(held):
            asking, own = zip(*held.pop(b))
            word, context, count, of, sizes = merged(own)
            asks = pack(np.array(asking), sizes, np.diff(of, prepend=of[:1] * 0))  # differences wrap around
            yield row(b, None, packed_pairs(word, context, count), asks, None)

    return parts.repartition(buckets, "bucket").mapInArrow(
        gather, "bucket int, chunk long, pairs binary, asks binary, entries binary")


# --- seating ----------------------------------------------------------------------

def seat(count: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables that ``count`` customers of one word take, seated one after another.

    ``fresh`` is the weight of a new table; an old one has its customers less the
    discount.
    """
    tables = (count > 0).astype(np.int64)
    order = np.flatnonzero(count > 1)
    order = order[np.argsort(-count[order], kind="stable")]
    left, weight, open_ = count[order], fresh[order], tables[order]
    seated, live = 1, len(order)  # of every word that still has customers to seat, the first ``live``
    while live:
        group = max(1, seated // GROUP)
        chance = weight[:live] / (seated - discount * open_[:live] + weight[:live])
        if group == 1:
            open_[:live] += rng.random(live) < chance
        else:
            open_[:live] += rng.binomial(np.minimum(left[:live] - seated, group), np.clip(chance, 0, 1))
        seated += group
        live = len(left) - int(np.searchsorted(left[::-1], seated, side="right"))
    tables[order] = open_
    return tables


class State:
    """What buckets share: tables and customers of the restaurants, and the root.

    In a bucket the restaurants are those of its own contexts, in their order. Hot
    words have their customers in the root (``hot``) and tables there (``hot_root``).
    """

    def __init__(self, customers, tables, known: int, root_customers: float, root_tables: float,
                 hot: dict[int, float], hot_root: dict[int, float] | None = None):
        self.customers, self.tables, self.known = customers, tables, known
        self.root_customers, self.root_tables, self.hot, self.hot_root = root_customers, root_tables, hot, hot_root or {}

    def at(self, customers: np.ndarray, tables: np.ndarray) -> State:
        """The state with these restaurants."""
        return State(customers, tables, self.known, self.root_customers, self.root_tables, self.hot, self.hot_root)

    def fresh(self) -> float:
        """Weight of a new table of the root, for any word."""
        return (ROOT_STRENGTH + ROOT_DISCOUNT * self.root_tables) / (self.known + 1)


def sums_of(names: np.ndarray, restaurants: pa.Table) -> list[np.ndarray]:
    """Customers, and tables of the last three states, of a bucket's restaurants in the order of ``names``."""
    packed = restaurants["held"].is_valid()
    rows, held = restaurants.filter(pc.invert(packed)), restaurants["held"].filter(packed)
    context = rows["context"].to_numpy().view(np.uint64)
    order = np.argsort(context)
    if not np.array_equal(context[order], names):
        raise ValueError("restaurants do not match the contexts of the bucket")
    tables, customers = (rows[c].to_numpy()[order] for c in ("tables", "customers"))
    customers, before, earlier = unpack(held[0].as_py()) if len(held) else (customers, tables * 0, tables * 0)
    return [v.astype(float) for v in (customers, tables, before, earlier)]


class Bucket:
    """The pairs of a bucket and their seating."""

    def __init__(self, word, context, count, state: State, seed: int):
        self.context, self.count, self.state = context.astype(np.int64), count, state
        self.rng = np.random.default_rng(seed)
        start = runs(word)
        self.word = word[start]
        self.of = np.repeat(np.arange(len(start)), np.diff(start, append=len(word)))
        self.hot = np.array([state.hot.get(w, -1.0) for w in self.word.tolist()]) if state.hot else np.full(len(start), -1.0)
        self.tables = (count > 0).astype(np.int64)
        self.seat_root()

    def seat_root(self) -> None:
        s = self.state
        own = np.bincount(self.of, weights=self.tables, minlength=len(self.word))
        self.customers = np.where(self.hot >= 0, self.hot, own).astype(np.int64)
        fresh = np.full(len(own), s.fresh())
        self.root = seat(self.customers, fresh, ROOT_DISCOUNT, self.rng)
        above = np.maximum(self.customers - ROOT_DISCOUNT * self.root, 0) + fresh
        self.unigram = above / (s.root_customers + ROOT_STRENGTH)

    def sweep(self) -> None:
        fresh = (STRENGTH + DISCOUNT * self.state.tables[self.context]) * self.unigram[self.of]
        self.tables = seat(self.count, fresh, DISCOUNT, self.rng)
        self.seat_root()

    def probability(self, after: State) -> np.ndarray:
        """Of every pair, given this seating and the sums of all seatings drawn with it."""
        customers, root = self.customers.astype(float), self.root.astype(float)
        for at in np.flatnonzero(self.hot >= 0):
            customers[at], root[at] = after.hot[int(self.word[at])], after.hot_root[int(self.word[at])]
        unigram = (np.maximum(customers - ROOT_DISCOUNT * root, 0) + after.fresh()) / (after.root_customers + ROOT_STRENGTH)
        held = np.maximum(self.count - DISCOUNT * self.tables, 0)
        fresh = (STRENGTH + DISCOUNT * after.tables[self.context]) * unigram[self.of]
        return (held + fresh) / (after.customers[self.context] + STRENGTH)


def drawn(word, at, count, state: State, number: int, b: int) -> Bucket:
    """The seating of bucket ``b`` in a round: always the same for the same state."""
    own = Bucket(word, at, count, state, (number << 32) + b)
    for _ in range(SWEEPS):
        own.sweep()
    return own


def averaged(word, names, at, count, b: int, restaurants: pa.Table, states: list[State]) -> tuple[Bucket, np.ndarray]:
    """A bucket and the mean probability of its pairs over the last two rounds."""
    customers, last, before, earlier = sums_of(names, restaurants)
    final = len(states) - 1
    mean = np.zeros(len(count))
    for number, old, new in ((final - 1, earlier, before), (final, before, last)):
        own = drawn(word, at, count, states[number - 1].at(customers, old), number, b)
        mean += own.probability(states[number].at(customers, new)) / 2
    return own, mean


#: Own tables of a bucket and, before the first round, its own customers. From then on a bucket holds in one more
#: row, packed, what does not change or is summed up: customers, and the tables one and two rounds earlier.
SEATED = "bucket int, context long, tables long, customers long, held binary"
ROOT, HOT = -1, -2  # rows of SEATED that are no restaurants: tables of the root, tables of a hot word in all of them


def first_seating(data: bytes, b: int) -> Iterator[pa.RecordBatch]:
    """SEATED rows of a bucket in which every pair has one table."""
    _, names, at, count = unpacked_pairs(data)
    tables = np.bincount(at, weights=count > 0, minlength=len(names)).astype(np.int64)
    customers = np.bincount(at, weights=count, minlength=len(names)).astype(np.int64)
    for i in range(0, len(names), RESTAURANTS):
        some = slice(i, i + RESTAURANTS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(names[some]), b, np.int32)), pa.array(names[some].view(np.int64)),
             pa.array(tables[some]), pa.array(customers[some]), pa.nulls(len(names[some]), pa.binary())],
            ["bucket", "context", "tables", "customers", "held"])


def opened(buckets: DataFrame) -> DataFrame:
    """SEATED rows before the first round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from first_seating(data, b)

    return buckets.select("bucket", "pairs").mapInArrow(run, SEATED)


def restaurants(seated: DataFrame) -> DataFrame:
    """SEATED rows with the sums over all buckets: what a bucket needs to know of its contexts."""
    context = Window.partitionBy("context")  # a row per bucket at most
    sums = seated.where("bucket >= 0 and held is null").select(
        "bucket", "context", *(F.sum(c).over(context).alias(c) for c in ("tables", "customers")), "held")
    return sums.union(seated.where("held is not null"))


def round_of(buckets: DataFrame, seated: DataFrame, state: State, number: int, hot: np.ndarray) -> tuple[DataFrame, State]:
    """Sample all buckets once: their SEATED rows, and the root."""
    spark = buckets.sparkSession
    sent = spark.sparkContext.broadcast(state)  # the root and the hot words

    def sample(left: pa.Table, right: pa.Table) -> pa.Table:
        b, data = left["bucket"][0].as_py(), left["pairs"][0].as_py()
        word, names, at, count = unpacked_pairs(data)
        whole, last, before, _ = sums_of(names, right)
        own = drawn(word, at, count, sent.value.at(whole, last), number, b)
        tables = np.bincount(at, weights=own.tables, minlength=len(names)).astype(np.int64)
        many = np.isin(own.word, hot)
        served = np.bincount(own.of, weights=own.tables, minlength=len(own.word))[many].astype(np.int64)
        held = pack(*(v.astype(np.int64) for v in (whole, last, before)))
        rest = 2 + len(served)  # what is held, the root, and the hot words
        return pa.table({
            "bucket": np.concatenate([np.full(len(names) + 1, b), [ROOT], np.full(len(served), HOT)]).astype(np.int32),
            "context": np.concatenate([names, np.zeros(2, np.uint64), own.word[many]]).view(np.int64),
            "tables": np.concatenate([tables, [0, own.root[~many].sum()], served]).astype(np.int64),
            "customers": np.zeros(len(names) + rest, np.int64),
            "held": pa.array([None] * len(names) + [held] + [None] * (rest - 1), pa.binary())})

    met = buckets.select("bucket", "pairs").groupBy("bucket").cogroup(restaurants(seated).groupBy("bucket"))
    seated = kept(met.applyInArrow(sample, SEATED), "seated")
    sent.unpersist()
    sums = {(r.kind, r.name): r.n for r in seated.groupBy(
        F.least("bucket", F.lit(0)).alias("kind"), F.when(F.col("bucket") == HOT, F.col("context")).alias("name")).agg(
        F.sum("tables").alias("n")).collect()}  # two rows and the hot words
    totals = {name & (1 << 64) - 1: float(n) for (kind, name), n in sums.items() if kind == HOT}
    # Hot words are few; each has its customers spread over buckets and is seated here.
    few = np.array(list(totals.values()), dtype=np.int64)
    served = seat(few, np.full(len(few), state.fresh()), ROOT_DISCOUNT, np.random.default_rng(number))
    root = sums.get((ROOT, None), 0) + int(served.sum())
    return seated, State(None, None, state.known, float(sums.get((0, None), 0)), float(root), totals,
                         dict(zip(totals, served.tolist())))


# --- scores -----------------------------------------------------------------------

def scored(buckets: DataFrame, entries: DataFrame, seated: DataFrame, states: list[State], counts: dict[int, int], total: int) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every document.

    A bucket answers every chunk with the values of its pairs, packed: logarithms as
    numbers of four bytes, and training counts of the words. A chunk puts the answers in
    the order of the buckets and sums them up for its documents.
    """
    sent = buckets.sparkSession.sparkContext.broadcast((states, counts))
    known = states[-1].known

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        states, hot_counts = sent.value
        b, pairs, asks = (left[j][0].as_py() for j in ("bucket", "pairs", "asks"))
        word, names, at, count = unpacked_pairs(pairs)
        own, mean = averaged(word, names, at, count, b, right, states)
        score = np.log10(mean).astype(np.float32)
        c = np.bincount(own.of, weights=own.count, minlength=len(own.word)).astype(np.int64)
        if hot_counts:
            c = np.array([hot_counts.get(w, n) for w, n in zip(own.word.tolist(), c.tolist())], dtype=np.int64)
        asking, sizes, step = unpack(asks)
        pair = np.cumsum(step, dtype=np.uint32)
        out, at = [], 0
        for n in sizes.tolist():
            some = pair[at:at + n]
            of = own.of[some]
            first = runs(of)
            out.append(pack(score[some], np.diff(first, append=n).astype(np.uint32), c[of[first]]))
            at += n
        return pa.table({"chunk": asking, "bucket": pa.array([b] * len(out), pa.int32()), "part": pa.array(out, pa.binary())})

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["bucket"].to_numpy())
        score, learned = [], []
        for i in order.tolist():
            s, per_word, c = unpack(right["part"][i].as_py())
            score.append(s)
            learned.append(np.repeat(c, per_word))
        per_pair, doc, n, doc_id, flag = unpack(left["entries"][0].as_py())
        c = np.concatenate(learned)
        base = np.log10((c + 0.5) / (total + 0.5 * (known + 1)))
        sums = [np.bincount(doc, weights=n, minlength=len(doc_id))]
        for values in (c > 0, base, np.concatenate(score)):
            sums.append(np.bincount(doc, weights=n * np.repeat(values, per_pair), minlength=len(doc_id)))
        return pa.table({
            "doc_id": pa.array(doc_id, mask=(flag & 2) > 0), "n_tokens": sums[0].astype(np.int64),
            "n_known": sums[1].astype(np.int64), "base_score": sums[2], "score": sums[3]})

    met = buckets.groupBy("bucket").cogroup(restaurants(seated).groupBy("bucket"))
    answers = met.applyInArrow(answer, "chunk long, bucket int, part binary")
    return entries.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        add, "doc_id long, n_tokens long, n_known long, base_score double, score double")


class Model:
    """What training leaves: buckets and entries, the restaurants and the states of all rounds."""

    def __init__(self, buckets, entries, seated, states, counts, total):
        self.buckets, self.entries, self.seated = buckets, entries, seated
        self.states, self.counts, self.total = states, counts, total


def trained(rows: DataFrame) -> Model:
    """Rows are (row, doc_id, text, train)."""
    words = kept(word_counts(rows), "word-counts")
    known, total, n_tokens = words.agg(F.count_if(F.col("c") > 0), *(F.coalesce(F.sum(x), F.lit(0)) for x in ("c", "n"))).first()
    buckets = bucket_count(n_tokens)
    often = words.where(F.col("n") * FREQUENT > n_tokens).select("word", "n").toArrow()  # FREQUENT rows at most
    often = often["word"].to_numpy().view(np.uint64)[np.argsort(-often["n"].to_numpy(), kind="stable")]
    numbers = WordNumbers(often, np.arange(len(often), dtype=np.uint64))
    hot_rows = words.where(F.col("n") * HOT_SHARE > BUCKET_TOKENS).collect()  # HOT_SHARE * buckets rows at most
    counts = {numbers.number(r.word & (1 << 64) - 1): r.c for r in hot_rows}
    hot = np.array(list(counts), dtype=np.uint64)
    discard(words)
    parts = kept(bucket_rows(dealt(rows, hot, buckets, numbers.names, numbers.ranks), buckets), "buckets")
    table = parts.where("bucket >= 0").select("bucket", "pairs", "asks")
    entries = parts.where("bucket < 0").select("chunk", "entries")
    seated = opened(table)
    states = [State(None, None, known, 0.6 * total, float(known), {w: 0.3 * c for w, c in counts.items()})]
    for number in range(1, ROUNDS + 1):
        old = seated
        seated, state = round_of(table, seated, states[-1], number, hot)
        states.append(state)
        if number > 1:
            discard(old)
    return Model(table, entries, seated, states, counts, total)


def score_texts(documents: DataFrame, folds: int = 5, held_out_fold: int = 1) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    ship(documents.sparkSession)
    fold = id_fold("doc_id", folds)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text",
        F.coalesce(fold != held_out_fold, F.lit(False)).alias("train"))
    model = trained(rows)
    out = scored(model.buckets, model.entries, model.seated, model.states, model.counts, model.total)
    return out.select("doc_id", F.coalesce(id_fold("doc_id", folds) == held_out_fold, F.lit(False)).alias("held_out"),
                      "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")

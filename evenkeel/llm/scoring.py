"""Language-model scores of documents from Elias-Fano n-gram tries.

The model is an interpolated n-gram model with absolute discounting over words:

    p1(w) = (c(w) + 1/2) / (N + (V + 1) / 2)
    pk(w | h) = (c(hw) - d) / c(h) [if hw occurs] + d x T(h) / c(h) x pk-1(w | shorter h)

T(h) is the number of different words after h; a context that never occurs passes on the
shorter one's probability. All n-grams of all training texts are kept.

The model is never in one place. Its n-grams are dealt to shards by their context; each
shard holds a trie level (``trie.TrieLevel``) that it builds, searches and drops. Texts are scored in
chunks of some million tokens. For each order:

1. a chunk sends its distinct n-grams, once each, with their counts in training texts, to the shards;
2. a shard adds the counts up, builds its trie, looks all n-grams asked for up, and answers each chunk;
3. contexts with more than ``HOT_COUNT`` tokens are dealt to all shards by the following word in the next order. They
   are at most N / ``HOT_COUNT`` many and at most ``MOST_HOT``, so their totals can be sent to every chunk.

At last each chunk meets its answers and scores its own texts. So what meets in a shard is one
entry per chunk for an n-gram, however often it occurs; chunks and shards have fixed sizes and their number
grows with the corpus. Chunks are cut again from the documents for each step rather than stored; an
answer that doesn't fit its chunk's n-grams raises.

Cases: a NULL or empty text is its end token alone. Documents with equal ids are all scored. With no
training text N and V are 0 and every probability is 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import hash_words, mixed, read_table, remainder, shared_folder, written
from evenkeel.llm.trie import CODES, TrieLevel, ranked

ORDER = 2
#: the order of the registered query
QUERY_ORDER = 3
DISCOUNT = 0.75
CHUNK_TOKENS = 1_000_000
#: characters of text for each shard
SHARD_CHARS = 10_000_000
HOT_COUNT = 200_000
MOST_HOT = 1_000_000
#: hashes that stand for the end and the beginning of a text
END, BEGIN = np.uint64(1), np.uint64(2)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

MESSAGE = "kind string, chunk string, shard long, payload binary, total long, different long"
MESSAGE_ARROW = pa.schema(
    [("kind", pa.string()), ("chunk", pa.string()), ("shard", pa.int64()), ("payload", pa.binary()),
     ("total", pa.int64()), ("different", pa.int64())]
)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed buffer; integers in the smallest type that holds them."""
    body = []
    for array in arrays:
        if array.dtype.kind in "iu" and len(array):
            array = array.astype(np.min_scalar_type(int(array.max())))
        planes = array.view(np.uint8).reshape(len(array), -1).T  # bytes of one significance lie together
        body.append(f"{array.dtype.str} {len(array)}\n".encode() + np.ascontiguousarray(planes).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(body))


def unpack(data: bytes) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 0
    while at < len(body):
        end = body.index(b"\n", at)
        kind, count = body[at:end].split()
        dtype, count = np.dtype(kind.decode()), int(count)
        size = dtype.itemsize * count
        planes = np.frombuffer(body, np.uint8, size, end + 1).reshape(dtype.itemsize, count)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype) if count else np.empty(0, dtype))
        at = end + 1 + size
    return out


def ordered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 in ascending order, and what sorts them so, equal ones as they come.

    Where a number and its place fit into 64 bits together, these are sorted, which is much faster, and hold both.
    """
    bits = len(values).bit_length()
    if not len(values) or int(values.max()).bit_length() + bits > 64:
        order = np.argsort(values, kind="stable")
        return values[order], order
    both = values.astype(np.uint64) << np.uint64(bits)
    order = _places(both, bits)
    both >>= np.uint64(bits)
    return both.astype(values.dtype, copy=False), order


def grouped(hashes: np.ndarray) -> np.ndarray:
    """What brings different hashes into about ascending order: by all bits but those that their places take."""
    bits = len(hashes).bit_length()
    return _places(hashes >> np.uint64(bits) << np.uint64(bits), bits)


def _places(values: np.ndarray, bits: int) -> np.ndarray:
    """The order of values whose last bits are free for their places; in place."""
    values |= np.arange(len(values), dtype=np.uint64)
    values.sort()
    return (values & np.uint64((1 << bits) - 1)).astype(np.int32 if bits < 32 else np.int64)


def starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = columns[0][1:] != columns[0][:-1]
    for column in columns[1:]:
        out[1:] |= column[1:] != column[:-1]
    return out


class Chunk:
    """Some documents as word numbers: for each, the beginning, its words and its end."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray, hashes: np.ndarray, training: np.ndarray):
        self.tokens, self.lengths, self.hashes, self.training = tokens, lengths, hashes, training
        self.document = np.repeat(np.arange(len(lengths)), lengths)

    @classmethod
    def of(cls, texts: pa.Array, training: np.ndarray) -> Chunk:
        """Words are numbered in the order in which they first come, after the end and the beginning."""
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
        found = lists.flatten().dictionary_encode()
        numbers = found.indices.to_numpy().astype(np.int64)
        words = found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        document = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        if b"" in words:  # what a text with white space at an end is split into there
            blank = words.index(b"")
            numbers, document = numbers[numbers != blank], document[numbers != blank]
            numbers -= numbers > blank
            del words[blank]
        lengths = np.bincount(document, minlength=len(lists)) + 2
        tokens = np.zeros(lengths.sum(), np.int64)
        tokens[np.cumsum(lengths) - lengths] = 1
        tokens[np.arange(len(numbers)) + 2 * document + 1] = numbers + 2
        return cls(tokens, lengths, np.concatenate([[END, BEGIN], hash_words(words)]), training)

    def levels(self, most: int, counted: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]]:
        """For each order up to ``most``: (contexts, words, training counts) of the different n-grams, and each token's place among them.

        Orders below ``counted`` come without counts.

        n-grams of a context stand together. The beginning of a text counts as a word of order 1, so that
        frequent contexts are known, and ends no longer n-gram; before the text there are only beginnings.
        The context of a token is the shorter n-gram that ends at the one before, so n-grams are told apart as
        pairs of its number and the token's.
        """
        training = self.training[self.document]  # one byte each, which the counts' gathers stay in the cache with
        different = len(self.hashes)
        contexts, words = np.zeros(different, np.uint64), np.arange(different)
        counts = np.bincount(self.tokens[training], minlength=different) if counted <= 1 else None
        yield contexts, self.hashes, counts, self.tokens
        ends = np.flatnonzero(self.tokens != 1)
        tokens, training = self.tokens[ends], training[ends]
        shorter, beginnings = self.tokens, np.zeros(1, np.uint64)
        for level in range(2, most + 1):
            with np.errstate(over="ignore"):
                hashes = mixed(contexts * MULTIPLIER + self.hashes[words])
                beginnings = mixed(beginnings * MULTIPLIER + BEGIN)
            by = grouped(hashes)
            rank = np.empty(len(by), np.int64)
            rank[by] = np.arange(len(by))
            pairs = rank[shorter[ends - 1]]
            pairs *= different
            pairs += tokens
            pairs, order = ordered(pairs)
            fresh = starts(pairs)
            place = np.empty(len(pairs), order.dtype)
            place[order] = np.cumsum(fresh, dtype=order.dtype) - 1
            counts = _sums(training[order], fresh) if counted <= level else None
            rank, words = np.divmod(pairs[fresh], different)
            contexts = hashes[by[rank]]
            del hashes, by, rank, pairs, order, fresh  # a chunk's arrays are its task's memory
            yield contexts, self.hashes[words], counts, place
            shorter = np.full(len(self.tokens), len(words), place.dtype)  # at the beginning of a text: beginnings alone
            shorter[ends] = place
            contexts, words = np.append(contexts, beginnings), np.append(words, 1)


def _sums(values: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """The sum of each stretch of whole numbers that begins where ``fresh`` is set."""
    upto = np.cumsum(values, dtype=np.int64)[np.append(np.flatnonzero(fresh)[1:], len(values)) - 1] if len(values) else np.empty(0, np.int64)
    return np.diff(upto, prepend=0)


def by_shard(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """What brings n-grams into the order of their shards, and where each shard begins and the last ends."""
    bounds = np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])
    # numbers of two bytes at most are sorted by counting
    return np.argsort(shard.astype(np.min_scalar_type(shards)), kind="stable"), bounds


def dealt(contexts: np.ndarray, words: np.ndarray, order: int, hot: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each n-gram: by its context, for hot ones by its word."""
    if order == 1:
        dealt_by = mixed(contexts ^ mixed(words))
    else:
        by_word = np.isin(contexts, hot) if len(hot) else np.zeros(len(words), bool)
        dealt_by = contexts.copy()
        dealt_by[by_word] = mixed(contexts[by_word] ^ mixed(words[by_word]))
    return (dealt_by % np.uint64(shards)).astype(np.int64)


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, list, Chunk]]:
    """(name, doc_ids, chunk) of a partition's documents, whole, about ``most`` tokens each."""
    part, held, size, number = TaskContext.get().partitionId(), [], 0, 0
    for batch in batches:
        begin, sizes = 0, pc.binary_length(batch["text"]).fill_null(0).to_pylist()
        for at, length in enumerate(sizes, 1):
            size += length // 6 + 2
            if size >= most:
                yield f"{part}-{number}", *_cut([*held, batch.slice(begin, at - begin)])
                begin, held, size, number = at, [], 0, number + 1
        if begin < len(sizes):
            held.append(batch.slice(begin))
    if held:
        yield f"{part}-{number}", *_cut(held)


def _cut(batches: list[pa.RecordBatch]) -> tuple[list, Chunk]:
    # concatenated, as kernels have got slices wrong that don't begin at 0
    ids, texts, training = (pa.concat_arrays([batch[name] for batch in batches]) for name in ("doc_id", "text", "training"))
    chunk = Chunk.of(texts, training.to_numpy(zero_copy_only=False).astype(bool))
    pa.default_memory_pool().release_unused()  # the words are numbers now
    return ids.to_pylist(), chunk


def _message(kind: str, chunk: str, shard: int, payload: bytes = b"", total: int = 0, different: int = 0) -> tuple:
    return kind, chunk, shard, payload, total, different


def _messages(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), MESSAGE_ARROW, strict=True)], schema=MESSAGE_ARROW)


def questions(order: int, hot: np.ndarray, shards: int, most: int) -> Callable:
    """Each chunk's different n-grams with their training counts, a message per shard."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, chunk in chunks(batches, most):
            for contexts, words, counts, _ in chunk.levels(order, counted=order):
                pass
            by, bounds = by_shard(dealt(contexts, words, order, hot, shards), shards)
            rows = []
            for shard in np.flatnonzero(np.diff(bounds)):
                mine = by[bounds[shard] : bounds[shard + 1]]
                rows.append(_message("ask", name, int(shard), _asked(contexts[mine], words[mine], counts[mine])))
            yield from _messages(rows).to_batches()

    return work


def _asked(contexts: np.ndarray, words: np.ndarray, counts: np.ndarray) -> bytes:
    first = np.flatnonzero(starts(contexts))
    vocabulary, number = ranked(words)
    return pack(contexts[first], np.diff(first, append=len(contexts)), vocabulary, number, counts)


def answers(order: int, discount: float, hot: np.ndarray, keep: bool) -> Callable:
    """A shard's work: add up, build the trie level, look up, answer every chunk."""

    def work(table: pa.Table) -> pa.Table:
        names, shard = table["chunk"].to_pylist(), table["shard"][0].as_py()
        asked = [unpack(payload) for payload in table["payload"].to_pylist()]
        counts = np.concatenate([count for *_, count in asked]).astype(np.int64)
        asked_contexts, rank = _ranks([context for context, *_ in asked])
        vocabulary, word = _ranks([vocabulary for _, _, vocabulary, *_ in asked])
        pairs = np.concatenate(
            [np.repeat(r, run) * len(vocabulary) + w[number] for r, w, (_, run, _, number, _) in zip(rank, word, asked, strict=True)]
        )
        sizes = [len(count) for *_, count in asked]
        del asked, word
        pairs, by = ordered(pairs)
        fresh = starts(pairs)
        sums = _sums(counts[by], fresh)
        back = np.empty(len(by), by.dtype)
        back[by] = np.cumsum(fresh, dtype=by.dtype) - 1
        place, spelt = np.divmod(pairs[fresh], len(vocabulary))
        del by, pairs, fresh, counts
        contexts, words = asked_contexts[place], vocabulary[spelt]
        seen = sums > 0
        data = TrieLevel.build(contexts[seen], words[seen], sums[seen], discount, exact=order == 1)
        level = TrieLevel(data)

        number, totals, kinds = level.find_contexts(asked_contexts)
        found = level.find_among(number[place], vocabulary, spelt)
        value = np.where(found >= 0, level.values[found] if level.followers.n else 0, 0)
        out, at = [], 0
        for name, mine, size in zip(names, rank, sizes, strict=True):
            payload = pack(value[back[at : at + size]], totals[mine], kinds[mine], np.array([level.low, level.step]))
            out.append(_message("answer", name, shard, payload))
            at += size
        for one in np.flatnonzero(sums >= HOT_COUNT):  # contexts of the next order, and how often they occur
            out.append(_message("hot", str(next_context(contexts[one], words[one])), shard, total=int(sums[one])))
        for one in np.flatnonzero(np.isin(asked_contexts, hot)):  # contexts of which this shard has a part
            name = str(int(asked_contexts[one]))
            out.append(_message("context", name, shard, total=int(totals[one]), different=int(kinds[one])))
        is_token = words[seen] != BEGIN
        out.append(_message("total", "", shard, total=int(sums[seen][is_token].sum()), different=int(is_token.sum())))
        if keep:
            out.append(_message("trie", "", shard, data))
        return _messages(out)

    return work


def _ranks(sequences: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different values of all sequences in ascending order, and each sequence as places among them."""
    different, place = ranked(np.concatenate(sequences))
    return different, np.split(place, np.cumsum([len(sequence) for sequence in sequences])[:-1])


def next_context(context: np.uint64, word: np.uint64) -> int:
    """The context that an n-gram is for the next order."""
    with np.errstate(over="ignore"):
        return int(mixed(np.array([context * MULTIPLIER + word], np.uint64))[0])


def score_documents(
    documents: DataFrame,
    training: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    discount: float = DISCOUNT,
    chunk_tokens: int = CHUNK_TOKENS,
    shard_chars: int = SHARD_CHARS,
    tries: str | None = None,
) -> DataFrame:
    """(doc_id, training, n_tokens, n_known, train_tokens, base_score, score) of every document.

    ``tries`` names a folder to keep the trie levels in, as a table (order, shard, payload).
    """
    spark = documents.sparkSession
    folder = shared_folder(spark)
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), training.alias("training"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // shard_chars))
    hot: dict[int, np.ndarray] = {1: np.empty(0, np.uint64)}
    hot_totals: dict[int, dict[str, np.ndarray]] = {}
    replies = None
    for level in range(1, order + 1):
        asks = rows.mapInArrow(questions(level, hot[level], shards, chunk_tokens), MESSAGE)
        said = asks.groupBy("shard").applyInArrow(answers(level, discount, hot[level], tries is not None), MESSAGE)
        said = written(said.withColumn("level", F.lit(level)), folder, f"level_{level}")
        if level == 1:
            total = said.where("kind = 'total'").agg(F.sum("total").alias("tokens"), F.sum("different").alias("words")).first()
        if level < order:
            hot[level + 1] = _hot_contexts(said)
        hot_totals[level] = _context_totals(said)
        if tries is not None:
            said.where("kind = 'trie'").select("level", "shard", "payload").write.mode("append").parquet(tries)
        some = said.where("kind = 'answer'").select("chunk", "level", "shard", "payload")
        replies = some if replies is None else replies.unionAll(some)
    tokens, kinds = int(total.tokens or 0), int(total.words or 0)
    kind = rows.schema["doc_id"].dataType.simpleString()
    texts = rows.mapInArrow(_whole(chunk_tokens), f"chunk string, ids array<{kind}>, payload binary")
    work = _scores(order, discount, shards, hot, hot_totals, tokens, kinds)
    return texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        work, f"doc_id {kind}, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def _hot_contexts(said: DataFrame) -> np.ndarray:
    """Contexts of the next order that are dealt by word: the most frequent, at most ``MOST_HOT``."""
    rows = said.where("kind = 'hot'").orderBy(F.desc("total"), "chunk").limit(MOST_HOT).select("chunk").collect()
    return np.sort(np.array([int(row.chunk) for row in rows], np.uint64))


def _context_totals(said: DataFrame) -> dict[str, np.ndarray]:
    """Total and different words of the hot contexts, summed over the shards; at most ``MOST_HOT``."""
    sums = said.where("kind = 'context'").groupBy("chunk").agg(F.sum("total"), F.sum("different")).collect()
    rows = sorted((int(context), total, different) for context, total, different in sums)
    names = ("context", "total", "different")
    return {name: np.array([row[n] for row in rows], np.int64 if n else np.uint64) for n, name in enumerate(names)}


def _whole(most: int) -> Callable:
    """Each chunk's documents as word numbers, one row per chunk."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, ids, chunk in chunks(batches, most):
            payload = pack(chunk.tokens, chunk.lengths, chunk.hashes, chunk.training.astype(np.uint8))
            yield pa.RecordBatch.from_pydict({"chunk": [name], "ids": [ids], "payload": [payload]})

    return work


def _scores(order: int, discount: float, shards: int, hot: dict, hot_totals: dict, tokens: int, kinds: int) -> Callable:
    """Score the documents of one chunk with the answers to its n-grams."""
    denominator = tokens + 0.5 * (kinds + 1)

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows != 1:
            raise ValueError("answers to a chunk that the documents don't give again")
        codes, lengths, hashes, training = unpack(left["payload"][0].as_py())
        chunk = Chunk(codes.astype(np.int64), lengths.astype(np.int64), hashes.astype(np.uint64), training.astype(bool))
        replies = {
            (level, shard): payload
            for level, shard, payload in zip(*(right[name].to_pylist() for name in ("level", "shard", "payload")), strict=True)
        }
        inside = chunk.tokens != 1
        document, count = chunk.document[inside], len(chunk.lengths)
        for level, (contexts, words, _, place) in enumerate(chunk.levels(order, counted=order + 1), 1):
            value, part, total, different = _read(replies, level, contexts, words, hot[level], shards)
            if level == 1:
                known = value[place][inside]
                base = probability = (known + 0.5) / denominator
                continue
            if len(hot_totals[level]["context"]):
                at = np.searchsorted(hot_totals[level]["context"], contexts) % len(hot_totals[level]["context"])
                is_hot = hot_totals[level]["context"][at] == contexts
                total = np.where(is_hot, hot_totals[level]["total"][at], total)
                different = np.where(is_hot, hot_totals[level]["different"][at], different)
            some = np.maximum(total, 1)
            seen, rest = (value * part / some)[place], (discount * different / some)[place]
            probability = np.where((total > 0)[place], seen + rest * probability, probability)

        def summed(weights: np.ndarray) -> np.ndarray:
            return np.bincount(document, weights, count)

        return pa.table(
            {
                "doc_id": left["ids"].combine_chunks().flatten(),
                "training": chunk.training,
                "n_tokens": chunk.lengths - 1,
                "n_known": summed(known > 0).astype(np.int64),
                "train_tokens": np.full(count, tokens, np.int64),
                "base_score": summed(np.log10(base)),
                "score": summed(np.log10(probability)),
            }
        )

    return work


def _read(
    replies: dict, order: int, contexts: np.ndarray, words: np.ndarray, hot: np.ndarray, shards: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each n-gram its value (a count for order 1, else a share of the part's total), and its context's part and totals."""
    by, bounds = by_shard(dealt(contexts, words, order, hot, shards), shards)
    value, part, different = np.zeros(len(words)), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for shard in np.flatnonzero(np.diff(bounds)):
        mine = by[bounds[shard] : bounds[shard + 1]]
        codes, totals, kinds, scale = unpack(replies[order, int(shard)])
        place = np.cumsum(starts(contexts[mine])) - 1
        if len(codes) != len(mine) or len(totals) != place[-1] + 1:
            raise ValueError("answers that don't fit the n-grams of their chunk")
        if order == 1:
            value[mine] = codes
        else:
            meant = 10 ** (scale[0] + (np.arange(CODES) - 1.0) * scale[1])  # of each code; 0 is an n-gram not found
            meant[0] = 0
            value[mine] = meant[codes]
        part[mine], different[mine] = totals[place], kinds[place]
    return value, part, part, different


def language_model_scores(spark, sf_dir: str) -> DataFrame:
    """``op5``: scores of all documents by a model of those that are not held out."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 5) == 1
    scored = score_documents(documents, ~held_out, order=QUERY_ORDER)
    return scored.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )

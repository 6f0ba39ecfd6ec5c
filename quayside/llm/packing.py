"""Packing of tokenized documents into as few fixed-size sequences as possible by a grouping genetic algorithm.

A solution is a set of bins (sequences).  Crossover injects whole well-filled bins of one parent into the other and removes
the bins that hold duplicates of injected documents, and a few of the emptiest.  Displaced documents first change places with one or two
documents of a bin where that fills the bin better; what is displaced then goes into the fullest bins it fits in (best fit).
A shard that best fit alone packs as tightly as its tokens allow does not evolve.  Documents are dealt to shards of bounded size; each shard is evolved on several islands at once, and after
each epoch the best solution of an island migrates to the next one.  The best solution's full bins are then settled; the
documents of the others are dealt out again, to ever fewer shards, so that no shard leaves its own half-empty bins.
"""

from __future__ import annotations

import bisect
import random
import re
import struct
import zlib
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame, Window, functions as F

from quayside.llm.bpe import byte_alphabet
from quayside.llm.common import LONGEST_KEY, TwoGenerationCache, arrow_map, durable

CAPACITY = 2048
SHARD_ITEMS = 4000   # documents of a shard, on average
ISLANDS = 2          # solutions evolved side by side per shard
EPOCHS = 2           # rounds of evolution; elites migrate in between
POPULATION = 8       # solutions of an island
CHILDREN = 8         # crossovers per island and epoch
ROUNDS = 3           # dealings of documents to shards
WORD_KEYS = 400_000  # bound of the word cache per Python worker, in keys per generation
SLICE_WORDS = 50_000 # words of a text looked up at once; what a slice adds to the cache beyond its bound


# Words whose letters have no other composed form (Latin-1 letters and ASCII), and the tokenizer's pieces of such words.
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
PLAIN_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u00ff0-9]+")
BYTE_CHARS = byte_alphabet()

# --- tokens --------------------------------------------------------------------------------------------------------

class WordIds:
    """Ids of whole texts through a cache by word.

    The tokenizer drops white space and never merges across it, so the ids of a text are those of its words in turn.
    Words new to the cache are encoded by the library: words of plain letters, digits and ASCII marks, which its normalizer
    only lower-cases, are cut here and go straight to its BPE model; all others take its whole way."""

    def __init__(self, path: str, keys: int = WORD_KEYS):
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"\Z.", re.I).search
        self.pieces = TwoGenerationCache(self._piece, keys // 8)
        self.keys, self.young, self.old = keys, {}, {}

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(BYTE_CHARS)
        ids = [t.id for t in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, word: str) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[p] for p in PLAIN_PIECES.findall(word.lower())])

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the text."""
        data = text.encode()
        if b"\xcc" not in data and b"\xcd" not in data and not self.added(text):
            data = data.lower()  # as the normalizer does; no combining mark that a capital might lack a composed form with
        words = data.split()  # at ASCII white space only
        return b"".join([self._slice(words[k:k + SLICE_WORDS]) for k in range(0, len(words), SLICE_WORDS)])

    def _slice(self, words: list[bytes]) -> bytes:
        """Ids of some words; what is new joins the young generation, long words only until they are looked up."""
        young, old = self.young, self.old
        ids = [*map(young.get, words)]
        if None in ids:
            new = {w for w, known in zip(words, ids) if known is None}
            others = []
            for w in new:
                known = old.get(w)
                if known is None:
                    word = w.decode()
                    if PLAIN.fullmatch(word) and not self.added(word):
                        known = self._plain(word)
                    else:
                        others.append(w)
                        continue
                young[w] = known
            if others:
                encodings = self.tokenizer.encode_batch_fast([w.decode() for w in others], add_special_tokens=False)
                for w, e in zip(others, encodings):
                    young[w] = np.array(e.ids, "<u4").tobytes()
            ids = [*map(young.__getitem__, words)]
            for w in new:
                if len(w) > LONGEST_KEY:
                    del young[w]
            if len(young) > self.keys:
                self.old, self.young = young, {}
        return b"".join(ids)


_LOADED: dict[str, WordIds] = {}


def loaded(path: str) -> WordIds:
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: each document's ids and a closing ``end_id``, cut into pieces of
    ``capacity`` ids where longer."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, closing = loaded(vocabulary), np.array([end_id], "<u4").tobytes()
        out: list[tuple] = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = words.encode(text.as_py() or "") + closing
            n = len(ids) // 4
            out.extend((doc_id, k, at, min(capacity, n - at), zlib.crc32(ids[4 * at:4 * (at + capacity)]))
                       for k, at in enumerate(range(0, n, capacity)))
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                          names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return arrow_map(docs.select(docs["doc_id"].cast("long"), docs["text"]), fn,
                     "doc_id long, piece int, start long, length long, ids_crc32 long")


# --- one shard -----------------------------------------------------------------------------------------------------

class Packing:
    """Bins over items ``0..n-1`` with an index of bins by free room, for best fit in constant time per item."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0  # bit r: some bin has room r

    def add_bin(self, items: list[int]) -> None:
        room = self.capacity - sum(self.sizes[i] for i in items)
        self.bins.append(items)
        self.room.append(room)
        self._list(len(self.bins) - 1, room)

    def _list(self, at: int, room: int) -> None:
        if not self.by_room[room]:
            self.mask |= 1 << room
        self.by_room[room].append(at)

    def best_fit(self, items: list[int]) -> None:
        """Puts items, longest first, where the least room is left."""
        for i in sorted(items, key=self.sizes.__getitem__, reverse=True):
            size = self.sizes[i]
            fitting = self.mask >> size
            if not fitting:
                self.add_bin([i])
                continue
            room = size + (fitting & -fitting).bit_length() - 1
            slot = self.by_room[room]
            at = slot.pop()
            if not slot:
                self.mask &= ~(1 << room)
            self.bins[at].append(i)
            self.room[at] = room - size
            self._list(at, room - size)

    def fitness(self) -> tuple[int, int]:
        """Fewer bins are better; then bins that differ more, the full ones fuller."""
        return len(self.bins), -sum((self.capacity - r) ** 2 for r in self.room)


def best_change(sizes: list[int], limit: int, least: int) -> tuple[int, tuple[int, ...]]:
    """The one or two positions of ``sizes`` (ascending) with the greatest sum over ``least`` and up to ``limit``; none: ``least, ()``."""
    found: tuple[int, ...] = ()
    end = bisect.bisect_right(sizes, limit)
    if end and sizes[end - 1] > least:
        least, found = sizes[end - 1], (end - 1,)
    low, high = 0, end - 1
    while low < high and least < limit:
        both = sizes[low] + sizes[high]
        if both > limit:
            high -= 1
            continue
        if both > least:
            least, found = both, (low, high)
        low += 1
    return least, found


def exchange(bins: list[list[int]], displaced: list[int], sizes: list[int], capacity: int) -> list[int]:
    """Displaced items after they changed places, one or two for one or two, with items of ``bins`` where a bin is fuller then."""
    free = sorted(displaced, key=sizes.__getitem__)
    waiting = [sizes[i] for i in free]
    for items in bins:
        room = capacity - sum([sizes[i] for i in items])
        while room and free:
            gain, outs, ins = 0, (), ()
            for some in (*combinations(items, 1), *combinations(items, 2)):
                held = sum([sizes[i] for i in some])
                reached, found = best_change(waiting, held + room, held + gain)
                if found:
                    gain, outs, ins = reached - held, some, found
                    if gain == room:
                        break
            if not gain:
                break
            room -= gain
            for k in reversed(ins):
                items.append(free.pop(k))
                waiting.pop(k)
            for i in outs:
                items.remove(i)
                k = bisect.bisect_left(waiting, sizes[i])
                waiting.insert(k, sizes[i])
                free.insert(k, i)
    return free


def crossover(one: Packing, other: Packing, rng: random.Random) -> Packing:
    """A child of ``other`` with whole well-filled bins of ``one``."""
    child = Packing(one.sizes, one.capacity)
    filled = sorted(range(len(one.bins)), key=one.room.__getitem__)[:max(1, 2 * len(one.bins) // 3)]
    n = rng.randint(1, max(1, len(filled) // 2))
    first = rng.randint(0, len(filled) - n)
    bins = [list(one.bins[b]) for b in filled[first:first + n]]
    taken = bytearray(len(one.sizes))
    for items in bins:
        for i in items:
            taken[i] = 1
    emptiest = set(sorted(range(len(other.bins)), key=other.room.__getitem__)[-3:])
    displaced = []
    for b, items in enumerate(other.bins):
        left = [i for i in items if not taken[i]]
        if len(left) == len(items) and b not in emptiest:
            bins.append(left)
        else:
            displaced.extend(left)
    displaced = exchange(bins, displaced, one.sizes, one.capacity)
    for items in bins:
        child.add_bin(items)
    child.best_fit(displaced)
    return child


def evolve(sizes: list[int], parents: list[list[list[int]]], capacity: int, children: int, seed: int) -> Packing:
    """The best packing after ``children`` crossovers among ``parents`` (lists of bins), the best-fit packing where there are none, and
    packings of which a random half is packed first."""
    rng = random.Random(seed)
    least = -(-sum(sizes) // capacity)
    population = []
    for bins in parents:
        p = Packing(sizes, capacity)
        for items in bins:
            p.add_bin(list(items))
        population.append(p)
    while len(population) < POPULATION:
        if any(len(p.bins) == least for p in population):
            break
        p = Packing(sizes, capacity)
        items = list(range(len(sizes)))
        if population:
            rng.shuffle(items)
            p.best_fit(items[: len(items) // 2])
            items = items[len(items) // 2:]
        p.best_fit(items)
        population.append(p)
    for _ in range(children):
        population.sort(key=Packing.fitness)
        if len(population[0].bins) == least:
            break
        child = crossover(*rng.sample(population, 2), rng)
        if child.fitness() < population[-1].fitness():
            population[-1] = child
    return min(population, key=Packing.fitness)


# --- all documents -------------------------------------------------------------------------------------------------

def _epoch(state: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """``state (shard, item, length, elites array<long>)`` with each island's elite solution after another epoch.
    Island k starts from its own elite and the one that migrates from island k-1."""
    islands = state.select("shard", "item", "length", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(ISLANDS - 1)),
        lambda k: F.struct(F.get("elites", k).alias("own"),
                           F.get("elites", (k + ISLANDS - 1) % ISLANDS).alias("guest")))).alias("island", "s")) \
        .select("shard", "island", "item", "length", "s.own", "s.guest")

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        shard, island = key[0].as_py(), key[1].as_py()
        rows = rows.sort_by("item")
        parents = []
        for column in (rows["own"], rows["guest"]):
            if not column.null_count:
                bins: dict = {}
                for i, b in enumerate(column.to_pylist()):
                    bins.setdefault(b, []).append(i)
                parents.append(list(bins.values()))
        best = evolve(rows["length"].to_pylist(), parents, capacity, CHILDREN, seed=shard * 1000 + island * 10 + epoch)
        assigned, rooms = np.empty(len(rows), "int64"), np.empty(len(rows), "int64")
        for b, items in enumerate(best.bins):
            assigned[items] = b
            rooms[items] = best.room[b]
        n = len(rows)
        return pa.table({"shard": np.full(n, shard, "int64"), "item": rows["item"], "length": rows["length"],
                         "island": np.full(n, island, "int32"), "bin": assigned, "room": rooms,
                         "n_bins": np.full(n, len(best.bins), "int64")})

    evolved = islands.groupBy("shard", "island").applyInArrow(
        run, "shard long, item long, length long, island int, bin long, room long, n_bins long")
    # one row per item again; n_bins holds each island's number of bins
    return evolved.groupBy("shard", "item", "length").agg(
        F.sort_array(F.collect_list(F.struct("island", "bin", "room", "n_bins"))).alias("found"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns with ``length``, 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Every row is placed once (repeated rows too); null keys do not matter, for rows get a number of their own; pieces of
    full length have a sequence for themselves; an empty table gives an empty result."""
    rows = durable(pieces.withColumn("__item", F.monotonically_increasing_id()))
    rest = rows.where(F.col("length") < capacity).select(F.col("__item").alias("item"), "length")
    settled = [rows.where(F.col("length") >= capacity).select(
        F.col("__item").alias("item"), F.col("__item").alias("sequence_id"))]
    for number in range(ROUNDS):
        n = rest.count()
        if not n:
            break
        shards = max(1, -(-n // SHARD_ITEMS))
        state = rest.select(F.pmod(F.xxhash64("item", F.lit(number)), F.lit(shards)).alias("shard"), "item", "length",
                            F.expr("cast(array() as array<bigint>)").alias("elites"))
        for epoch in range(EPOCHS):
            found = _epoch(state, capacity, epoch)
            state = found.select("shard", "item", "length", F.col("found.bin").alias("elites"))
        best = found.select("shard", "item", "length", F.array_min(F.transform(
            "found", lambda s: F.struct(s["n_bins"].alias("n_bins"), s["island"].alias("island"), s["bin"].alias("bin"),
                                        s["room"].alias("room")))).alias("s")).select("shard", "item", "length", "s.bin", "s.room")
        best = durable(best)
        last = number == ROUNDS - 1 or shards == 1
        full = F.lit(True) if last else F.col("room") <= capacity // 512
        # a number of its own for every bin: round, shard and bin side by side
        settled.append(best.where(full).select("item", (F.lit(number + 1).cast("long") * (1 << 58)
                                                        + F.col("shard") * (1 << 20) + F.col("bin")).alias("sequence_id")))
        if last:
            break
        rest = best.where(~full).select("item", "length")
    placed = reduce(DataFrame.unionByName, settled)
    in_bin = Window.partitionBy("sequence_id").orderBy("__item")
    return (rows.join(placed.withColumnRenamed("item", "__item"), "__item")
            .withColumn("offset", F.sum("length").over(in_bin) - F.col("length")).drop("__item"))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Documents ``(doc_id, text)`` tokenized, cut and packed: one row per piece with ``doc_id, piece, start, length,
    ids_crc32, sequence_id, offset``.  A null text is empty (the closing id alone); null ids and repeated rows stay
    rows of their own; other columns are ignored; an empty table gives an empty result."""
    return pack(token_pieces(docs, vocabulary, capacity), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

"""Language-model scores by a weighted backoff automaton.

Counts come from all training texts. The root of the automaton is the add-one unigram model over
every token seen; words and bigrams that some longer n-gram begins with are states, with arcs
for their discounted bigrams or trigrams, and a failure arc to the state of the shorter history,
whose weight returns the discounted mass. A text is read from left to right, once: a state is carried
along, a word takes the arc of the state or, while there is none, its failure arcs, and the weights add up.

The tables of states and arcs are as large as the input makes them. The most frequent part of the
automaton, which is one itself, is broadcast and walked. An arc outside that part adds a gain: its weight
less those of the way that the walk takes without it. These n-grams are looked up by a join, and
the sum is that of a walk over the whole automaton.

Words are known by 64-bit hashes; a second hash of every word proves that no two of a corpus share one.
N-grams are looked up by a 64-bit hash of theirs. Counts and look-ups move in wide rows, one for each bucket
of n-grams; the buckets are as many as the size of the texts asks for, so each stays small.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmetrics.llm.common import in_fold, not_in_fold, ship_package, stored, whole_bytes
from reelmetrics.llm.index import Index
from reelmetrics.llm.packed import joined, packed, top, unpacked
from reelmetrics.llm.wordhash import blocks, hash_places, mixed, words_of_texts

#: The ids of the end and of the start of a text among those of its words.
END, START = -1, -2
#: Bits of a filter for each of its entries, of a whole filter at most, and of one of its rows.
BITS_EACH, MOST_BITS, ROW_BITS = 16, 1 << 28, 1 << 15
#: Bytes of text that are counted or scored at a time, and words that are walked in one go.
BLOCK, PIECE = 1 << 21, 512
#: N-grams that a task counts or looks up before it sends them, and texts that it scores before.
HELD, HELD_TEXTS = 1 << 20, 1 << 16
#: Bytes of all texts for a bucket of counts, and for a bucket of look-ups.
COUNTED, ASKED = 1 << 22, 1 << 24


@dataclass(frozen=True)
class Size:
    """What belongs to the automaton, and how much of it is broadcast.

    All n-grams seen ``least_count`` times or more have arcs, unless ``words`` or ``arcs`` bound the
    words that n-grams are made of, or the bigrams, and as many trigrams: then the most frequent
    ones are kept, and all that are as frequent as the first left out are left out too.
    ``near_words`` and ``near_arcs`` only bound what is broadcast; the result is the same.
    """

    words: float = math.inf
    arcs: float = math.inf
    least_count: int = 3
    discount: float = 0.75
    near_words: int = 300_000
    near_arcs: int = 300_000


# -- texts as numbers --------------------------------------------------------------------


@dataclass
class _Block:
    """Texts in a row, each between a start and an end."""

    #: Distinct ids, and which of them stands at each place.
    ids: np.ndarray
    which: np.ndarray
    #: The text of each place, and the words of each text.
    doc: np.ndarray
    sizes: np.ndarray
    #: A second hash of the distinct ids, 0 for marks.
    second: np.ndarray

    @staticmethod
    def of(texts: list[bytes], seed: int) -> _Block:
        data, starts, lengths, bounds = words_of_texts(texts)
        sizes = np.diff(bounds)
        doc = np.repeat(np.arange(len(texts)), sizes + 2)
        firsts = np.concatenate([[0], np.cumsum(sizes + 2)[:-1]])
        framed = np.empty(len(doc), np.int64)
        inner = np.ones(len(doc), bool)
        inner[firsts] = inner[firsts + sizes + 1] = False
        framed[inner] = hash_places(data, starts, lengths, 2 * seed).view(np.int64)
        framed[firsts], framed[firsts + sizes + 1] = START, END
        ids, at, which = np.unique(framed, return_index=True, return_inverse=True)
        word = np.cumsum(inner)[at] - 1
        real = inner[at]
        second = np.zeros(len(ids), np.int64)
        second[real] = hash_places(data, starts[word[real]], lengths[word[real]], 2 * seed + 1).view(np.int64)
        return _Block(ids, which, doc, sizes, second)

    def pairs(self) -> np.ndarray:
        """Where bigrams begin: at every place but the ends."""
        return np.flatnonzero(self.ids[self.which[:-1]] != END)


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A place of each distinct row of small numbers, which one each row is, and how often it occurs."""
    code = columns[0].astype(np.int64)
    for c in columns[1:]:
        code = code * (int(c.max()) + 1 if len(c) else 1) + c
    order = np.argsort(code)
    code = code[order]
    new = np.concatenate([[True], code[1:] != code[:-1]])[: len(code)]
    begin = np.flatnonzero(new)
    which = np.empty(len(code), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[begin], which, np.diff(np.append(begin, len(code)))


# -- filters -----------------------------------------------------------------------------


# The primes of XXH64, and the seed that Spark begins with.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_SEED = 42


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def _key(*ids: np.ndarray) -> np.ndarray:
    """The key of an n-gram: what ``xxhash64`` of Spark makes of the ids of its words."""
    with np.errstate(over="ignore"):
        key = np.full(len(ids[0]), np.uint64(_SEED))
        for x in ids:
            key = (key + _P5 + np.uint64(8)) ^ (_turned(x.view(np.uint64) * _P2, 31) * _P1)
            key = _turned(key, 27) * _P1 + _P4
            key = (key ^ key >> np.uint64(33)) * _P2
            key = (key ^ key >> np.uint64(29)) * _P3
            key = key ^ key >> np.uint64(32)
    return key


@dataclass
class _Filter:
    """A set of bits, two for each n-gram, that tells which can't be in a table; those in the table always pass."""

    bits: np.ndarray

    def has(self, *ids: np.ndarray) -> np.ndarray:
        key, last = _key(*ids), np.uint64(8 * len(self.bits) - 1)
        return self._set(key & last) & self._set(key >> np.uint64(32) & last)

    def _set(self, slot: np.ndarray) -> np.ndarray:
        return (self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _filter(table: DataFrame, *names: str) -> _Filter:
    """The filter of a table's n-grams; it grows with the table up to ``MOST_BITS``."""
    size, entries = ROW_BITS, table.count()
    while size < MOST_BITS and size < BITS_EACH * entries:
        size *= 2
    key = F.xxhash64(*names)
    slot = F.explode(F.array(key.bitwiseAND(F.lit(size - 1)), F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(size - 1)))).alias("slot")
    rows = (
        table.select(slot)
        .select(F.shiftright("slot", 15).alias("row"), F.col("slot").bitwiseAND(F.lit(ROW_BITS - 1)).alias("bit"))
        .groupBy("row")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    bits = np.zeros(size // 8, np.uint8)
    for r in rows.toLocalIterator():
        bits[r["row"] * ROW_BITS // 8 : (r["row"] + 1) * ROW_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
    return _Filter(bits)


# -- counting ----------------------------------------------------------------------------


def most_frequent(counts: DataFrame, limit: float) -> DataFrame:
    """Rows with the largest ``n``, at most ``limit``: those from some level of ``n`` on; all without a limit.

    Levels are numbers up to 1024, then steps of one percent. A small table of rows per level
    tells where to cut, so no task has to sort or gather the rows.
    """
    if limit == math.inf:
        return counts
    level = F.when(F.col("n") < 1024, F.col("n")).otherwise(F.floor(F.log2("n") * 64) + 384)
    left, cut = limit, None
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        left -= r["count"]
        if left < 0:
            break
        cut = r["level"]
    return counts.filter(F.lit(False) if cut is None else level >= cut)


def _bits(total: int, each: int) -> int:
    """The bits that number enough buckets for ``total``, with about ``each`` in one."""
    return max(3, (total // each).bit_length())


def _added(grams: list[np.ndarray], n: np.ndarray, bits: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Distinct n-grams in the order of their buckets, with those and the sums of their counts.

    The bucket is told by a hash of all words. Below it the words' own first bits sort, so equal first
    words come together.
    """
    if not len(n):
        return np.zeros(0, np.uint64), grams, n
    key = np.zeros(len(n), np.uint64)
    for g in grams:
        key = mixed(key + g.view(np.uint64))
    left = 64 - bits
    key = key >> np.uint64(left)
    for k, g in enumerate(grams):
        own = left // (len(grams) - k)
        left -= own
        key = key << np.uint64(own) | top(g, own)
    order = np.argsort(key)

    def differ(x: np.ndarray) -> np.ndarray:
        return x[1:] != x[:-1]

    key = key[order]
    new = np.any([differ(g[order]) for g in grams], axis=0)
    if np.any(new & ~differ(key)):  # different n-grams of one key may lie mixed
        order = order[np.lexsort([g[order] for g in grams] + [key])]
        new = np.any([differ(g[order]) for g in grams], axis=0)
    begin = np.flatnonzero(np.concatenate([[True], new]))
    return top(key[begin], bits), [g[order][begin] for g in grams], np.add.reduceat(n[order], begin)


def _counts(texts: DataFrame, grams, names: list[str], bits: int, least: dict[int, int]) -> DataFrame:
    """The rows ``kind`` and ``names`` that ``grams`` makes of blocks of texts, with the sum of their counts ``n``.

    Of each kind only those that sum up to its ``least`` count. Tasks add up what they hold and send it by buckets.
    """
    columns = [*names, "n"]

    def sent(held: dict[int, list[list[np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for kind in list(held):
            *words, n = (np.concatenate(c) for c in zip(*held.pop(kind)))
            bucket, words, n = _added(words, n, bits)
            bucket, *wide = packed(bucket, [*words, n])
            yield pa.RecordBatch.from_arrays([bucket, pa.array(np.full(len(bucket), kind)), *wide], ["bucket", "kind", *columns])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[list[np.ndarray]]] = {}
        for batch in batches:
            for run in blocks((t.as_py() for t in batch.column(0)), BLOCK):
                for kind, *found in grams(run):
                    held.setdefault(kind, []).append([np.ascontiguousarray(c, np.int64) for c in found])
                if sum(len(part[0]) for parts in held.values() for part in parts) > HELD:
                    yield from sent(held)
        yield from sent(held)

    def summed(bucket: pa.Table) -> pa.Table:
        kinds, out = bucket.column("kind").to_numpy(), []
        for kind in np.unique(kinds).tolist():
            rows = bucket.filter(pa.array(kinds == kind))
            *words, n = (joined(unpacked(rows.column(c), np.int64), np.int64) for c in columns)
            _, words, n = _added(words, n, bits)
            often = n >= least[kind]
            out.append([np.full(often.sum(), kind), *(c[often] for c in (*words, n))])
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], ["kind", *columns])

    wide = texts.mapInArrow(count, "bucket bigint, kind bigint, " + ", ".join(f"{c} binary" for c in columns))
    return wide.groupBy("bucket").applyInArrow(summed, ", ".join(f"{c} bigint" for c in ["kind", *columns]))


def _words_and_pairs(texts: DataFrame, size: Size, bits: int) -> tuple[DataFrame, DataFrame, int]:
    """``word, n`` of all words and ends, ``a, b, n`` of the bigrams that are frequent enough, and the seed of the hashes.

    Words come with their second hash; should two words share an id, all is counted anew with other hashes.
    """
    for seed in range(8):

        def grams(run: list[bytes], seed: int = seed) -> Iterator[tuple]:
            block = _Block.of(run, seed)
            n = np.bincount(block.which, minlength=len(block.ids))
            real = block.ids != START
            yield 1, block.ids[real], block.second[real], n[real]
            at = block.pairs()
            a, b = block.which[at], block.which[at + 1]
            first, _, n = _distinct(a, b)
            yield 2, block.ids[a[first]], block.ids[b[first]], n

        counts = stored(_counts(texts, grams, ["a", "b"], bits, {1: 1, 2: size.least_count}), "lm-counted")
        words = counts.filter("kind = 1").select(F.col("a").alias("word"), "n")
        if words.groupBy("word").count().filter("count > 1").isEmpty():
            return words, counts.filter("kind = 2").select("a", "b", "n"), seed
    raise RuntimeError("words can't be told apart by 64 bits")


def _triples(texts: DataFrame, kept, seed: int, least: int, bits: int) -> DataFrame:
    """``a, b, c, n`` of the trigrams that occur ``least`` times or more and whose bigrams may have arcs."""

    def grams(run: list[bytes]) -> Iterator[tuple]:
        block = _Block.of(run, seed)
        at = block.pairs()
        passed = np.zeros(len(block.which), bool)
        passed[at] = kept.value.has(block.ids[block.which[at]], block.ids[block.which[at + 1]])
        at = np.flatnonzero(passed[:-1] & passed[1:])
        words = [block.which[at + k] for k in range(3)]
        pair = _distinct(words[0], words[1])[1]
        first, _, n = _distinct(pair, words[2])
        yield 3, *(block.ids[w[first]] for w in words), n

    return stored(_counts(texts, grams, ["a", "b", "c"], bits, {3: least}).drop("kind"), "lm-counted-3")


# -- the automaton -----------------------------------------------------------------------


def _left(kept: Column, lower: Column) -> Column:
    """log10 of a failure weight: what the arcs leave, over the lower model's mass of the words without an arc."""
    return F.log10((1 - kept) / F.greatest(1 - lower, F.lit(1e-12)))


def _arcs(bigrams: DataFrame, listed: DataFrame, size: Size) -> DataFrame:
    """``a, b, n, before, p, root`` of the bigrams that are kept: their weights in the state of a word, and at the root.

    ``listed`` has ``word, n, root``, with ``n`` as the times that the word precedes a token. An arc of count n weighs
    (n - discount) / before.
    """
    joined = bigrams.join(listed.select(F.col("word").alias("a"), F.col("n").alias("before")), "a").join(
        listed.select(F.col("word").alias("b"), "root"), "b"
    )
    joined = joined.select("a", "b", "n", "before", ((F.col("n") - size.discount) / F.col("before")).alias("p"), "root")
    kept = joined if size.arcs == math.inf else most_frequent(stored(joined, "lm-pairs"), size.arcs)
    return stored(kept, "lm-bigrams")


def _long_arcs(trigrams: DataFrame, pairs: DataFrame, size: Size) -> DataFrame:
    """``a, b, c, n, p, lower`` of the trigrams that are kept: their weights in the state of a bigram, and one below."""
    joined = trigrams.join(pairs.select("a", "b", F.col("n").alias("before")), ["a", "b"]).join(
        pairs.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("p").alias("lower")), ["b", "c"]
    )
    joined = joined.select("a", "b", "c", "n", ((F.col("n") - size.discount) / F.col("before")).alias("p"), "lower")
    kept = joined if size.arcs == math.inf else most_frequent(stored(joined, "lm-triples"), size.arcs)
    return stored(kept, "lm-trigrams")


def _near_level(words: DataFrame, pairs: DataFrame, triples: DataFrame, size: Size) -> list[int]:
    """The least counts of words, bigrams and trigrams that are broadcast.

    No n-gram is broadcast without those that it is made of: these are as frequent at least, and the counts asked
    of longer ones are no smaller.
    """
    levels, least = [], 1
    for table, limit in ((words, size.near_words), (pairs, size.near_arcs), (triples, size.near_arcs)):
        left = most_frequent(table, limit).agg(F.min("n")).first()[0]
        least = max(least, (1 << 62) if left is None else left)
        levels.append(least)
    return levels


@dataclass
class _Automaton:
    """States and arcs as arrays. State 0 is the root, then come the words, then the bigrams that have arcs.

    ``failing`` leads from a state to that of the shorter history, at ``failure``. An arc is found by its
    state and the place of its word; at the root every word has one.
    """

    words: np.ndarray
    root: np.ndarray
    unknown: float
    failing: np.ndarray
    failure: np.ndarray
    arcs: np.ndarray
    weights: np.ndarray
    targets: np.ndarray

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def places(self, ids: np.ndarray) -> np.ndarray:
        """The place of each id among the words, -1 for others."""
        if "_of_words" not in self.__dict__:
            self._of_words, self._of_arcs = Index(self.words.view(np.uint64)), Index(self.arcs.view(np.uint64))
        return self._of_words.places(ids.view(np.uint64)).astype(np.int64)

    def arc(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The place of the arc of a state for a word, -1 if there is none."""
        return self._of_arcs.places((state.astype(np.int64) * (len(self.words) + 1) + word).astype(np.uint64))

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a word each, and the weights of the way there."""
        state, weight = state.copy(), np.zeros(len(state))
        after = np.zeros(len(state), np.int64)
        known = word >= 0
        going = np.flatnonzero(known & (state > 0))
        while len(going):
            arc = self.arc(state[going], word[going])
            found = arc >= 0
            there, arc = going[found], arc[found]
            weight[there] += self.weights[arc]
            after[there], state[there] = self.targets[arc], -1
            lost = going[~found]
            weight[lost] += self.failure[state[lost]]
            state[lost] = self.failing[state[lost]]
            going = lost[state[lost] > 0]
        # A word that is not here has no arc anywhere: all failures down to the root.
        going = np.flatnonzero(~known & (state > 0))
        while len(going):
            weight[going] += self.failure[state[going]]
            state[going] = self.failing[state[going]]
            going = going[state[going] > 0]
        at_root = np.flatnonzero(known & (state == 0))
        weight[at_root] += self.root[word[at_root]]
        after[at_root] = word[at_root] + 1
        weight[~known] += self.unknown
        return after, weight

    def walk(self, block: _Block) -> np.ndarray:
        """The weights of each text, read from left to right with the state that the start leads to.

        Long texts are walked in pieces, all at once: the state depends on the last two words, so a piece
        begins two words earlier, from the root, and counts nothing there.
        """
        words = self.places(block.ids)[block.which]
        score = np.zeros(len(block.sizes))
        firsts = np.concatenate([[0], np.cumsum(block.sizes + 2)[:-1]])
        # Pieces: where the counting begins and ends; the start of a text itself is never counted.
        n_pieces = -(-(block.sizes + 1) // PIECE)
        doc = np.repeat(np.arange(len(block.sizes)), n_pieces)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        begin = firsts[doc] + 1 + number * PIECE
        end = np.minimum(begin + PIECE, firsts[doc] + block.sizes[doc] + 2)
        at = np.maximum(begin - 2, firsts[doc])
        order = np.argsort(at - end, kind="stable")  # the longest first
        doc, begin, end, at = doc[order], begin[order], end[order], at[order]
        state = np.zeros(len(doc), np.int64)
        while len(at):
            state, weight = self.step(state, words[at])
            counted = at >= begin
            score += np.bincount(doc[counted], weight[counted], len(score))
            at = at + 1
            going = int(np.count_nonzero(at < end))  # those that end sooner come last
            doc, begin, end, at, state = (x[:going] for x in (doc, begin, end, at, state))
        return score


def _automaton(words: DataFrame, pairs: DataFrame, triples: DataFrame, unknown: float) -> _Automaton:
    """The part of the automaton that is broadcast, from ``word, root, fail``, ``a, b, p, fail2`` and ``a, b, c, p``."""

    def columns(df: DataFrame, ids: str, *numbers: str) -> list[np.ndarray]:
        table = df.toArrow()
        found = [table.column(c).to_numpy().astype(np.int64) for c in ids.split()]
        return found + [table.column(c).to_numpy().astype(np.float64) for c in numbers]

    ids, root, fail = columns(words, "word", "root", "fail")
    order = np.argsort(ids.view(np.uint64))
    ids, root, fail = ids[order], root[order], fail[order]

    def place(x: np.ndarray) -> np.ndarray:
        return np.searchsorted(ids.view(np.uint64), x.view(np.uint64))

    a, b, p, fail2 = columns(pairs, "a b", "p", "fail2")
    a, b = place(a), place(b)
    code = a * len(ids) + b
    order = np.argsort(code)
    a, b, p, fail2, code = a[order], b[order], p[order], fail2[order], code[order]
    x, y, z, p3 = columns(triples, "a b c", "p")
    x, y, z = place(x), place(y), place(z)
    first, second = np.searchsorted(code, x * len(ids) + y), np.searchsorted(code, y * len(ids) + z)
    # Bigrams that no trigram begins with are no states: they lead to the state of their last word.
    is_state = fail2 != 0
    is_state[first] = True
    number = np.where(is_state, len(ids) + np.cumsum(is_state), b + 1)
    wide = len(ids) + 1
    arcs = np.concatenate([(a + 1) * wide + b, number[first] * wide + z])
    weights, targets = np.concatenate([np.log10(p), np.log10(p3)]), np.concatenate([number, number[second]])
    order = np.argsort(arcs)
    none = np.zeros(1)
    failing = np.concatenate([np.zeros(1 + len(ids), np.int64), b[is_state] + 1])
    return _Automaton(
        ids, root, unknown, failing, np.concatenate([none, fail, fail2[is_state]]), arcs[order], weights[order], targets[order]
    )


def _gains(words: DataFrame, pairs: DataFrame, triples: DataFrame, unknown: float) -> DataFrame:
    """``key, known, base, gain``: what each n-gram that is not broadcast adds to a text's score.

    A word adds its weight at the root less that of an unknown one and, as a state that is left, its failure weight. A
    bigram's arc replaces both that of its first word and the root's, and adds the failure weight of its
    own state; a trigram's arc replaces that and the bigram's.
    """
    more, nil = F.col("root") - F.lit(unknown), F.lit(0.0)
    one = words.select(F.xxhash64("word").alias("key"), F.lit(1).alias("known"), more.alias("base"), (more + F.col("fail")).alias("gain"))
    two = pairs.select(
        F.xxhash64("a", "b").alias("key"), F.lit(0).alias("known"), nil.alias("base"),
        (F.log10("p") - F.col("fail") - F.log10("root") + F.col("fail2")).alias("gain"),
    )
    three = triples.select(
        F.xxhash64("a", "b", "c").alias("key"), F.lit(0).alias("known"), nil.alias("base"),
        (F.log10("p") - F.col("fail2") - F.log10("lower")).alias("gain"),
    )
    return one.unionByName(two).unionByName(three)


@dataclass
class _Model:
    """What tasks need to score: the automaton, the unigram weights and filters for all n-grams that have arcs."""

    automaton: _Automaton
    seed: int
    words: _Filter
    pairs: _Filter
    triples: _Filter

    def scored(self, run: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Number of words, known words, base score and score by text; and the texts and keys of the n-grams to look up."""
        auto, block = self.automaton, _Block.of(run, self.seed)
        n = len(block.sizes)
        score = auto.walk(block)
        near = auto.places(block.ids)
        place, starts = near[block.which], block.ids[block.which] == START
        base = np.where(place >= 0, auto.root[place], auto.unknown) if len(auto.root) else np.full(len(place), auto.unknown)
        base = np.bincount(block.doc, np.where(starts, 0.0, base), n)
        known = np.bincount(block.doc, (place >= 0) & ~starts, n).astype(np.int64)

        asked: list[list[np.ndarray]] = []

        def ask(kind: int, at: np.ndarray) -> None:
            asked.append([block.doc[at], _key(*(block.ids[block.which[at + k]] for k in range(kind)))])

        listed = (near < 0) & self.words.has(block.ids) & (block.ids != START)
        ask(1, np.flatnonzero(listed[block.which]))
        at = block.pairs()
        passed = np.zeros(len(block.which), bool)
        passed[at] = self.pairs.has(block.ids[block.which[at]], block.ids[block.which[at + 1]])
        at = np.flatnonzero(passed)
        # Which arc a bigram that passes takes, if it is here; its target is its state.
        arc = np.full(len(block.which), -1)
        both = at[(place[at] >= 0) & (place[at + 1] >= 0)] if len(at) else at
        arc[both] = auto.arc(place[both] + 1, place[both + 1])
        ask(2, at[arc[at] < 0])
        at = np.flatnonzero(passed[:-1] & passed[1:])
        ids = [block.ids[block.which[at + k]] for k in range(3)]
        at = at[self.triples.has(*ids)]
        here = np.zeros(len(at), bool)
        state = np.where(arc[at] >= 0, auto.targets[arc[at]] if len(auto.targets) else 0, 0)
        maybe = np.flatnonzero((state > len(auto.words)) & (place[at + 2] >= 0))
        here[maybe] = auto.arc(state[maybe], place[at[maybe] + 2]) >= 0
        ask(3, at[~here])
        return [block.sizes, known, base, score], [np.concatenate(c) for c in zip(*asked)]


# -- scoring -----------------------------------------------------------------------------

_NUMBERS = "times bigint, known bigint, base double, score double"


def _walked(model, bits: int):
    names = ["bucket", "home", "at", "own", "times", "known", "base", "score", "keys", "places", "asked"]

    def sent(texts: list, asks: list[list[np.ndarray]], home: int) -> Iterator[pa.RecordBatch]:
        """A row for each text, and one for each bucket of look-ups: keys in order, the place of the text, and how often."""
        own = pa.concat_arrays([t[0] for t in texts])
        n = len(own)
        numbers = [np.concatenate(c) for c in zip(*(t[1] for t in texts))]
        at = pa.array(np.arange(n))
        homes = pa.array(np.full(n, home))
        none = [pa.nulls(n, pa.binary())] * 3
        rows = [pa.array(np.arange(n) + home & (1 << bits) - 1), homes, at, own, *map(pa.array, numbers), *none]
        yield pa.RecordBatch.from_arrays(rows, names)
        place, key = (np.concatenate(c) for c in zip(*asks))
        order = np.argsort(key, kind="stable")
        place, key = place[order], key[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (place[1:] != place[:-1])])[: len(key)]
        begin = np.flatnonzero(new)
        times = np.diff(np.append(begin, len(key))).astype(np.int32)
        bucket, *wide = packed(top(key[begin], bits), [key[begin], place[begin], times])
        n = len(bucket)
        kinds = [pa.int64(), own.type, pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([bucket, pa.array(np.full(n, home)), *(pa.nulls(n, k) for k in kinds), *wide], names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, asks, home, n, held = [], [], 0, 0, 0
        for whole in batches:
            for begin in range(0, len(whole), HELD_TEXTS):
                batch, done = whole.slice(begin, HELD_TEXTS), 0
                for run in blocks((t.as_py() for t in batch.column(2)), BLOCK):
                    if n and (held > HELD or n + len(run) > HELD_TEXTS):
                        yield from sent(texts, asks, home)
                        texts, asks, n, held = [], [], 0, 0
                    home = home if n else batch.column(0)[done].as_py()
                    numbers, (doc, key) = model.value.scored(run)
                    texts.append((batch.column(1).slice(done, len(run)), numbers))
                    asks.append([(doc + n).astype(np.uint16), key])
                    done, n, held = done + len(run), n + len(run), held + len(key)
        if n:
            yield from sent(texts, asks, home)

    return walk


def _gains_by_bucket(bits: int):
    names = ["bucket", "keys", "known", "base", "gain"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def sent() -> pa.RecordBatch:
            key, *numbers = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(key.view(np.uint64))
            columns = packed(top(key[order], bits), [c[order] for c in (key, *numbers)])
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            if sum(len(part[0]) for part in held) > HELD:
                yield sent()
        if held:
            yield sent()

    return deal


def _looked_up(walked: pa.Table, gains: pa.Table) -> pa.Table:
    """The texts of a bucket as they are, and sums of the gains that its look-ups found, for the texts of each home.

    The look-ups are most of a bucket. They are read where they lie, row by row, and never copied.
    """
    key, known, base, gain = (
        joined(unpacked(gains.column(c), k), k)
        for c, k in (("keys", np.uint64), ("known", np.int32), ("base", np.float64), ("gain", np.float64))
    )
    order = np.argsort(key)
    key, known, base, gain = (c[order] for c in (key, known, base, gain))
    asking = walked.column("keys").is_valid()
    passing = walked.drop_columns(["bucket", "keys", "places", "asked"]).filter(walked.column("keys").is_null())
    homes = walked.column("home").filter(asking)
    names = ["places", "more_known", "more_base", "more_gain"]
    sums: list[list[bytes]] = [[] for _ in names]
    for i in np.flatnonzero(asking.to_numpy()).tolist():
        keys, places, times = (np.frombuffer(walked.column(c)[i].as_buffer(), k) for c, k in (("keys", np.uint64), ("places", np.uint16), ("asked", np.int32)))
        at = np.searchsorted(key, keys)
        found = np.flatnonzero(at < len(key))
        found = found[key[at[found]] == keys[found]]
        at, places, times = at[found], places[found], times[found]
        told = np.flatnonzero(np.bincount(places))
        here = [np.bincount(places, times * c[at])[told] for c in (known, base, gain)]
        for out, c in zip(sums, [told.astype(np.uint16), here[0].astype(np.int64), *here[1:]]):
            out.append(c.tobytes())
    for name in names:
        passing = passing.append_column(name, pa.nulls(len(passing), pa.binary()))
    none = {f.name: pa.nulls(len(homes), f.type) for f in passing.schema if f.name not in (*names, "home")}
    more = pa.table({**none, "home": homes, **{k: pa.array(c, pa.binary()) for k, c in zip(names, sums)}})
    return pa.concat_tables([passing, more.select(passing.column_names)])


def _summed(home: pa.Table) -> pa.Table:
    """Rows of the texts of one home with all that they gained."""
    text = home.column("places").is_null()
    texts, more = home.filter(text), home.filter(home.column("places").is_valid())
    at = texts.column("at").to_numpy()
    sums = {c: np.zeros(len(at), k) for c, k in (("known", np.int64), ("base", np.float64), ("score", np.float64))}
    kinds = (("places", np.uint16), ("more_known", np.int64), ("more_base", np.float64), ("more_gain", np.float64))
    for places, *gained in zip(*(unpacked(more.column(c), k) for c, k in kinds)):
        for total, c in zip(sums.values(), gained):
            total[places] += c
    columns = {"own": texts.column("own"), "times": texts.column("times")}
    return pa.table({**columns, **{c: texts.column(c).to_numpy() + total[at] for c, total in sums.items()}})


def lm_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = 7, held: int = 2, size: Size = Size()
) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    The model learns from documents whose crc32 of the id modulo ``parts`` is not ``held``.
    ``base_score`` is the add-one unigram log10 probability, ``score`` that of the automaton; both
    count the end of a text as a token. Null text counts as empty, which has only the end. A
    null id is neither learnt from nor held out. Rows that repeat an id give a row each. If there
    is nothing to learn, ``train_tokens`` is 0 and every token has the probability of an unseen
    one. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.filter(not_in_fold(id_col, parts, held)).select(whole_bytes(text_col).alias("text"))
    length, learnt = F.octet_length(whole_bytes(text_col)), not_in_fold(id_col, parts, held)
    n_bytes, n_learnt = docs.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in (length, F.when(learnt, length))]).first()
    words, counted, seed = _words_and_pairs(texts, size, _bits(n_learnt, COUNTED))
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    scale = float(total + kinds + 1)
    unknown = -math.log10(scale)
    ends = sum(r["n"] for r in words.filter(F.col("word") == END).collect())

    root = (F.col("n") + 1) / F.lit(scale)
    real = words.filter(F.col("word") != END)
    # A bigram is no more frequent than its words.
    often = real.filter(F.col("n") >= size.least_count) if size.words == math.inf else most_frequent(real, size.words)
    marks = spark.createDataFrame([(END, ends), (START, ends)], "word bigint, n bigint")
    listed = often.select("word", "n").union(marks).withColumn("root", root)
    pairs = _arcs(counted, listed, size)
    kept = _filter(pairs, "a", "b")
    triples = _long_arcs(_triples(texts, spark.sparkContext.broadcast(kept), seed, size.least_count, _bits(n_learnt, COUNTED)), pairs, size)
    heads = pairs.groupBy("a").agg(_left(F.sum("p"), F.sum("root")).alias("fail"))
    tails = triples.groupBy("a", "b").agg(_left(F.sum("p"), F.sum("lower")).alias("fail2"))

    # All parts with the failure weights that their states have.
    nil = F.lit(0.0)
    every = real.union(marks).filter("n > 0")
    one = stored(
        every.join(heads.withColumnRenamed("a", "word"), "word", "left").select("word", "n", F.log10(root).alias("root"), F.coalesce("fail", nil).alias("fail")),
        "lm-words",
    )
    two = stored(
        pairs.join(heads, "a", "left").join(tails, ["a", "b"], "left")
        .select("a", "b", "n", "p", "root", F.coalesce("fail", nil).alias("fail"), F.coalesce("fail2", nil).alias("fail2")),
        "lm-pairs",
    )
    three = stored(triples.join(tails, ["a", "b"]).select("a", "b", "c", "n", "p", "lower", "fail2"), "lm-triples")
    levels = _near_level(one.filter(F.col("word") >= 0).unionByName(one.filter(F.col("word") < -2)), two, three, size)
    marked = F.col("word").isin(END, START)
    near = _automaton(
        one.filter((F.col("n") >= levels[0]) | marked), two.filter(F.col("n") >= levels[1]), three.filter(F.col("n") >= levels[2]), unknown
    )
    far = (one.filter((F.col("n") < levels[0]) & ~marked), two.filter(F.col("n") < levels[1]), three.filter(F.col("n") < levels[2]))
    model = spark.sparkContext.broadcast(_Model(near, seed, _filter(far[0], "word"), kept, _filter(three, "a", "b", "c")))

    own = F.struct(F.col(f"`{id_col}`").alias("doc_id"), in_fold(id_col, parts, held).alias("held_out"))
    fields = f"home bigint, at bigint, own struct<doc_id:{docs.schema[id_col].dataType.simpleString()},held_out:boolean>, {_NUMBERS}"
    bits = _bits(n_bytes, ASKED)
    walked = docs.select(F.monotonically_increasing_id().alias("row"), own.alias("own"), whole_bytes(text_col).alias("text")).mapInArrow(
        _walked(model, bits), f"bucket bigint, {fields}, keys binary, places binary, asked binary"
    )
    gains = _gains(*far, unknown).mapInArrow(_gains_by_bucket(bits), "bucket bigint, keys binary, known binary, base binary, gain binary")
    more = ", ".join(f"{c} binary" for c in ("places", "more_known", "more_base", "more_gain"))
    found = walked.groupBy("bucket").cogroup(gains.groupBy("bucket")).applyInArrow(_looked_up, f"{fields}, {more}")
    scored = found.groupBy("home").applyInArrow(_summed, fields.split(", ", 2)[2])
    return scored.select(
        "own.*",
        (F.col("times") + 1).alias("n_tokens"),
        F.col("known").alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )

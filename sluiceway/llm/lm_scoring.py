"""Language-model scores from an n-gram trie in Elias-Fano form, spread over shards.

The model interpolates trigrams with bigrams, and those with add-one unigrams. Counts come from all training texts:
blocks of documents exchange their distinct n-grams with shards (see corpus_blocks). A shard
holds the trie of its contexts: the context words, monotone pointers to their successors, the
successors relative to their context, pointers from these bigrams to the words after them, these
words relative to their bigram, and quantised probabilities, all in memory-mapped
files that are searched with the blocks' questions. Words are numbered: the exchange that
counts them gives each 64-bit hash its rank, so contexts and successors are exact numbers and
not digits of a hash. Contexts with more than 1/1024 of all tokens are dealt over many shards
by successor, a fixed share of all shards, so no shard grows with a frequent word.

p(w | c) = a * count(c w) / count(c) + (1 - a) * p(w), with a weight `a` by the size of the
context's count that each shard fits to its counts by expectation maximisation, leaving each
occurrence out of its own estimate. So repeated passages count where they repeat, and texts
like no other are scored as by the unigrams alone.

p(w | b c) = a * count(b c w) / count(b c) + (1 - a) * p(w | c). A trigram is in the shard of its
first two words, which doesn't know p(w | c): there `a` is fitted against the least unigram, so it
is the share of occurrences of which the trigram occurs elsewhere too.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm import corpus_blocks, elias_fano
from sluiceway.llm.common import give_back, materialize, release
from sluiceway.llm.corpus_blocks import NUMBERS, Layout, block_texts, by_shard, chain_hashes, cut_shards, exchange, pack, pack_numbers, shard_bits, unpack, unpack_numbers, word_hashes, write_blocks
from sluiceway.llm.elias_fano import EliasFano

BEGIN, END = (chain_hashes([np.array([i], np.uint64)] * 3)[0] for i in (1, 2))
#: A context with more than 1 / HOT of all tokens is dealt over one SPREAD-th of the shards, but SPREAD of them at least.
HOT = 1024
SPREAD = 64
LOW = np.uint64(0xFFFFFFFF)
#: Probabilities are kept in steps of STEP decades, rounded down; below LEAST decades they are 0.
STEP, LEAST = 0.03, -7.62
WEIGHT = 65535
#: The same for contexts of two words.
WEIGHT2 = 255


def in_training(doc_ids: list, parts: int, held: int) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % parts != held for i in doc_ids], bool)


def spread(bits: int) -> int:
    """Shards that a hot context is dealt over."""
    return 1 << max(SPREAD.bit_length() - 1, bits - SPREAD.bit_length() + 1)


class Tokens:
    """A block's tokens: words and an end for each text, as places in its sorted distinct words."""

    def __init__(self, row: dict, parts: int, held: int) -> None:
        words, counts = word_hashes(block_texts(row))
        self.n = counts + 1
        ends = np.cumsum(self.n) - 1
        tokens = np.full(len(words) + len(counts), END, np.uint64)
        inner = np.ones(len(tokens), bool)
        inner[ends] = False
        tokens[inner] = words
        self.starts = ends - counts
        self.training = in_training(row["doc_ids"], parts, held)
        self.trains = np.repeat(self.training, self.n)
        self.words, self.at = np.unique(tokens, return_inverse=True)


class Contexts:
    """The block's bigrams by context.

    keys: sorted, a shard and 32 digits of the context's number. pairs: sorted, a place in keys and
    32 digits of the successor's number; pair_of: the place of each token's pair. A hot context has
    a key in each of its shards that the block has a pair in, with its count in `known`. Numbers are
    exact up to 2**32 distinct words.
    """

    def __init__(self, t: Tokens, counts: np.ndarray, ids: np.ndarray, begin: int, total: int, bits: int) -> None:
        names = np.append(ids, begin).astype(np.uint64) & LOW
        shards = np.append(t.words, BEGIN) >> np.uint64(64 - bits)
        every, deal = np.uint64((1 << bits) - 1), spread(bits)
        totals = np.append(counts, counts[np.searchsorted(t.words, END)])
        hot = totals * HOT > total
        before = np.empty_like(t.at)
        before[1:] = t.at[:-1]
        before[t.starts] = len(t.words)
        used = np.zeros(len(names), bool)
        used[before] = True
        own, plain = shards << np.uint64(32) | names, np.flatnonzero(~hot & used)
        on = np.flatnonzero(hot[before])  # the tokens after hot contexts, each in one of its context's shards
        dealt, dealt_of = np.unique(before[on].astype(np.uint64) << np.uint64(32) | names[t.at[on]] & np.uint64(deal - 1), return_inverse=True)
        self._dealt = (dealt >> np.uint64(32)).astype(np.int64)
        extra = (shards[self._dealt] + (dealt & LOW) & every) << np.uint64(32) | names[self._dealt]
        self.keys = np.sort(np.concatenate([own[plain], extra]))
        # where each context's keys are, so that no token has to be searched for
        self._plain, self._place, places = plain, np.searchsorted(self.keys, own[plain]), np.searchsorted(self.keys, extra)
        self.known = np.zeros(len(self.keys), np.int64)
        self.known[places] = totals[self._dealt]
        place = np.zeros(len(names), np.int64)
        place[plain] = self._place
        place = place[before]
        place[on] = places[dealt_of]
        self.pairs, self.pair_of = np.unique(place.astype(np.uint64) << np.uint64(32) | names[t.at], return_inverse=True)
        self.before, self.names = before, names

    def taken(self, of_keys: np.ndarray, of_hot: dict[int, float]) -> np.ndarray:
        """What bigrams take of each word as a context: of a hot one, by its number, what those of all its shards take together."""
        out = np.zeros(len(self.names))
        out[self._plain] = of_keys[self._place]
        words = np.unique(self._dealt)
        out[words] = [of_hot.get(i, 0.0) for i in self.names[words].tolist()]
        return out


def trigrams(t: Tokens, c: Contexts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The block's trigrams: (sorted distinct ones, tokens that have one, place of each of these tokens' trigram).

    A trigram is the place of its first two words' pair and 32 digits of the third word's number; the first
    token of a text has none, the second one has BEGIN as its first word.
    """
    inner = np.ones(len(t.at), bool)
    inner[t.starts] = False
    inner = np.flatnonzero(inner)
    third = c.names[t.at[inner]]
    found, place = np.unique(c.pair_of[inner - 1].astype(np.uint64) << np.uint64(32) | third, return_inverse=True)
    return found, inner, place


# Words and their counts.


COUNTED = "shard int, block long, counts binary, ranks binary, v long, n long, known long"
WORDS = Layout(({"words": "<u8", "counts": "<u4"},), (), {"counts": (0, "<u8"), "ranks": (0, NUMBERS)})


def count_words(table: DataFrame, bits: int, parts: int, held: int) -> DataFrame:
    """COUNTED: training counts of the block's words, and their ranks among the shard's words, the most frequent first.

    Where block is negative, of the shard: v and n, words and occurrences in training, and known, all words.
    """
    fan = corpus_blocks.FAN

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                t = Tokens(row, parts, held)
                counts = np.bincount(t.at[t.trains], minlength=len(t.words))
                shards, at, whole = by_shard(t.words, bits, fan)
                cut = list(zip(at, at[1:], strict=False))
                yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(np.full(len(shards), row["block"])), pa.array(whole, pa.binary()), pa.array([pack(t.words[a:b]) for a, b in cut], pa.binary()), pa.array([pack(counts[a:b].astype("<u4")) for a, b in cut], pa.binary())], names=["shard", "block", "shards", "words", "counts"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        words = [unpack(x, "<u8") for x in pdf["words"]]
        known, inverse = np.unique(np.concatenate(words), return_inverse=True)
        totals = np.bincount(inverse, np.concatenate([unpack(x, "<u4") for x in pdf["counts"]]), len(known)).astype("<u8")
        rank = np.empty(len(known), np.uint32)
        rank[np.argsort(-totals.astype(np.int64), kind="stable")] = np.arange(len(known), dtype=np.uint32)
        ends, given, ranks = np.cumsum([0, *map(len, words)]), totals[inverse], rank[inverse]
        cut = list(zip(ends, ends[1:], strict=False))
        blocks = pdf[["shard", "block"]].assign(counts=[pack(given[a:b]) for a, b in cut], ranks=[pack_numbers(ranks[a:b]) for a, b in cut], v=0, n=0, known=0)
        return pd.concat([blocks, pd.DataFrame({"shard": pdf["shard"][:1], "block": -1, "counts": [b""], "ranks": [b""], "v": int((totals > 0).sum()), "n": int(totals.sum()), "known": len(known)})])

    asked = table.select("block", "doc_ids", "sizes", "text").mapInArrow(ask, "shard int, block long, shards binary, words binary, counts binary")
    return exchange(asked, bits, WORDS, answer, COUNTED)


def word_counts(row: dict, words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Training counts and numbers of the block's words. A number is a rank in a shard and the shard: frequent words have small ones."""
    parts = sorted(row["counts"], key=lambda x: x["shard"])
    counts = np.concatenate([unpack(x["counts"], "<u8") for x in parts]).astype(np.int64)
    ranks = np.concatenate([unpack_numbers(x["ranks"]) for x in parts]).astype(np.int64)
    return counts, ranks << bits | (words >> np.uint64(64 - bits)).astype(np.int64)


# The trie of a shard.


def fit_weights(count: np.ndarray, total: np.ndarray, plain: np.ndarray, rounds: int = 30) -> np.ndarray:
    """The weight of bigrams for each size (binary digits) of the context's count, by expectation maximisation.

    count, total: of each bigram and its context; plain: probability of the successor. An
    occurrence is left out of its own estimate: (count - 1) / (total - 1).
    """
    sizes, steps = 64, 256
    size = np.frexp(total.astype(float))[1]
    fit = total > 1
    ratio = np.log2(np.maximum(count - 1, 2**-20) / np.maximum(total - 1, 1) / plain)
    cell = size * steps + np.clip(np.round(4 * ratio) + steps // 2, 0, steps - 1).astype(np.int64)
    held = np.bincount(cell[fit], count[fit], sizes * steps).reshape(sizes, steps)
    odds = 2.0 ** ((np.arange(steps) - steps // 2) / 4)
    weight = np.full(sizes, 0.1)
    for _ in range(rounds):
        share = weight[:, None] * odds / (weight[:, None] * odds + 1 - weight[:, None])
        weight = (held * share).sum(1) / np.maximum(held.sum(1), 1e-9)
        weight = np.clip(weight, 1e-6, 0.99)
    weight[held.sum(1) == 0] = 1e-6
    weight[1] = weight[2]  # nothing is left of a single occurrence
    return weight


def encode_shares(shares: np.ndarray) -> np.ndarray:
    codes = np.floor((np.log10(np.maximum(shares, 1e-30)) - LEAST) / STEP) + 1
    return np.clip(codes, 0, 255).astype(np.uint8)


def build_trie(pairs: np.ndarray, counts: np.ndarray, given: dict[int, int], plain: np.ndarray, triples: np.ndarray, triple_counts: np.ndarray, least: float, width: int, folder: str, dealt: int = SPREAD) -> Path:
    """Writes the levels of a shard: contexts, and pointers, successors, probabilities and weights of contexts of one and two words.

    pairs: sorted, 32 digits of the context and 32 of the successor, all with counts;
    given: counts of contexts that other shards have parts of. triples: sorted, the place of the
    first two words in pairs and 32 digits of the third, all with counts; least: the least
    probability of a word; width: digits of a word's number, which is all that the levels keep;
    dealt: over how many shards the contexts of `given` are, whose parts are rounded the finer.
    """
    ctx = (pairs >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.diff(ctx, prepend=-1))
    borders = np.append(starts, len(pairs))
    rank = np.repeat(np.arange(len(starts)), np.diff(borders))
    names = ctx[starts]
    own = np.add.reduceat(counts, starts) if len(starts) else np.zeros(0, np.int64)
    total = own.copy()
    hot = np.flatnonzero(np.isin(names, list(given))) if given else np.zeros(0, np.int64)
    for i in hot.tolist():
        total[i] = max(total[i], given[int(names[i])])
    size = np.frexp(total.astype(float))[1]
    weight = fit_weights(counts, total[rank], plain) if len(pairs) else np.zeros(64)
    share = weight[size][rank] * counts / total[rank]
    taken = np.ceil(weight[size] * own / total * WEIGHT)
    units = WEIGHT * dealt // SPREAD
    part = np.minimum(np.ceil(weight[size] * own / total * units), units - 1)
    relative = lambda place, word: place.astype(np.uint64) << np.uint64(width) | word & LOW
    of = (triples >> np.uint64(32)).astype(np.int64)
    weight2 = fit_weights(triple_counts, counts[of], np.full(len(of), least)) if len(of) else np.zeros(64)
    size2 = np.frexp(counts.astype(float))[1]
    share2 = weight2[size2][of] * triple_counts / counts[of]
    levels = {
        "width": [np.array([width])],
        "contexts": elias_fano.encode(names.astype(np.uint64), 1 << 32),
        "pointers": elias_fano.encode(borders, len(pairs) + 1),
        "successors": elias_fano.encode(relative(rank, pairs), max(len(starts), 1) << width),
        "probabilities": [encode_shares(share)],
        "hot": [names[hot], part[hot].astype(np.int64)],
        "weights": [np.clip(taken, 0, WEIGHT - 1).astype(np.uint16)],
        "pointers_2": elias_fano.encode(np.append(0, np.cumsum(np.bincount(of, minlength=len(pairs)))), len(triples) + 1),
        "successors_2": elias_fano.encode(relative(of, triples), max(len(pairs), 1) << width),
        "probabilities_2": [encode_shares(share2)],
        "weights_2": [np.clip(np.ceil(weight2[size2] * WEIGHT2), 0, WEIGHT2 - 1).astype(np.uint8)],
    }
    for name, arrays in levels.items():
        for i, a in enumerate(arrays):
            np.save(f"{folder}/{name}{i}.npy", a)
    return Path(folder)


class Trie:
    """A shard's trie, its levels memory-mapped."""

    def __init__(self, folder: Path) -> None:
        read = lambda name, i: np.load(folder / f"{name}{i}.npy", mmap_mode="r").view(np.ndarray)
        names = ("contexts", "pointers", "successors", "pointers_2", "successors_2")
        self.contexts, self.pointers, self.successors, self.pointers_2, self.successors_2 = (EliasFano(*(read(name, i) for i in range(5))) for name in names)
        self.width = int(read("width", 0)[0])
        self.hot = dict(zip(*(read("hot", i).tolist() for i in range(2)), strict=True))
        self.probabilities, self.weights, self.probabilities_2, self.weights_2 = (read(name, 0) for name in ("probabilities", "weights", "probabilities_2", "weights_2"))

    def look_up(self, ctx: np.ndarray, numbers: np.ndarray, words: np.ndarray, numbers_2: np.ndarray, words_2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codes of the words, numbers[i] of them after context i, and the weights of the contexts; 0 where unknown.

        Then the same of words_2, numbers_2[i] of them after word i and its context, and of these pairs.
        """
        codes, weights = np.zeros(len(words), np.uint8), np.zeros(len(ctx), np.uint16)
        codes_2, weights_2 = np.zeros(len(words_2), np.uint8), np.zeros(len(words), np.uint8)
        if not self.contexts.n:
            return codes, weights, codes_2, weights_2
        place = self.contexts.find(ctx)
        weights[place >= 0] = self.weights[place[place >= 0]]
        asked, found = self._below(self.pointers, self.successors, place, numbers, words)
        codes[asked] = self.probabilities[found]
        if not self.successors_2.n:
            return codes, weights, codes_2, weights_2
        pair = np.full(len(words), -1)
        pair[asked] = found
        weights_2[asked] = self.weights_2[found]
        asked, found = self._below(self.pointers_2, self.successors_2, pair, numbers_2, words_2)
        codes_2[asked] = self.probabilities_2[found]
        return codes, weights, codes_2, weights_2

    def _below(self, pointers: EliasFano, successors: EliasFano, place: np.ndarray, numbers: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the words, numbers[i] of them after the context at place[i] (-1: unknown), those that the level has, and where."""
        known = place >= 0
        some = np.zeros(len(place), bool)  # contexts with a range of successors between their pointers
        some[known] = pointers.get(place[known] + 1) > pointers.get(place[known])
        asked = np.flatnonzero(np.repeat(some, numbers))
        found = successors.find(np.repeat(place, numbers)[asked].astype(np.uint64) << np.uint64(self.width) | words[asked])
        return asked[found >= 0], found[found >= 0]


QUESTIONS = "shard int, block long, shards binary, ctx binary, numbers binary, known binary, words binary, counts binary, plain binary, numbers_2 binary, words_2 binary, counts_2 binary"
#: hot: the parts that bigrams take of hot contexts in a shard, in a row of block -1.
ANSWERS = "shard int, block long, codes binary, weights binary, codes_2 binary, weights_2 binary, hot map<long, long>"
NGRAMS = Layout(
    ({"ctx": NUMBERS, "numbers": "<u4", "known": "<u8"}, {"words": NUMBERS, "counts": "<u4", "plain": "u1", "numbers_2": "<u4"}, {"words_2": NUMBERS, "counts_2": "<u4"}),
    ("numbers", "numbers_2"),
    {"codes": (1, "u1"), "weights": (0, "<u2"), "codes_2": (2, "u1"), "weights_2": (1, "u1")},
)


def ngram_answers(joined: DataFrame, bits: int, total: int, distinct: int, begin: int, parts: int, held: int) -> DataFrame:
    """ANSWERS to each block's bigrams and trigrams from the tries of all shards. joined: blocks with their words' counts."""
    fan = corpus_blocks.FAN

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                t = Tokens(row, parts, held)
                counts, ids = word_counts(row, t.words, bits)
                c = Contexts(t, counts, ids, begin, total, bits)
                keys, known, pairs, pair_of = c.keys, c.known, c.pairs, c.pair_of
                times = np.bincount(pair_of[t.trains], minlength=len(pairs))
                level = np.minimum(np.round(8 * np.log2(counts + 1.0)), 255).astype(np.uint8)
                plain = np.zeros(len(pairs), np.uint8)
                plain[pair_of] = level[t.at]
                numbers = np.bincount((pairs >> np.uint64(32)).astype(np.int64), minlength=len(keys))
                ends = np.append(0, np.cumsum(numbers))
                shards, at, whole = cut_shards((keys >> np.uint64(32)).astype(np.int64), bits, fan)
                cut = list(zip(at, at[1:], strict=False))
                binary = lambda a, kind, c: pa.array([pack(a[x:y].astype(kind)) for x, y in c], pa.binary())
                numbers_ = lambda a, c: pa.array([pack_numbers(a[x:y]) for x, y in c], pa.binary())
                inner = [(ends[a], ends[b]) for a, b in cut]
                triples, having, triple_of = trigrams(t, c)
                times_2 = np.bincount(triple_of[t.trains[having]], minlength=len(triples))
                numbers_2 = np.bincount((triples >> np.uint64(32)).astype(np.int64), minlength=len(pairs))
                ends_2 = np.append(0, np.cumsum(numbers_2))
                inner_2 = [(ends_2[a], ends_2[b]) for a, b in inner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards, pa.int32()), pa.array(np.full(len(cut), row["block"])), pa.array(whole, pa.binary()), numbers_(keys & LOW, cut), binary(numbers, "<u4", cut), binary(known, "<u8", cut)]
                    + [numbers_(pairs & LOW, inner), binary(times, "<u4", inner), binary(plain, "u1", inner)]
                    + [binary(numbers_2, "<u4", inner), numbers_(triples & LOW, inner_2), binary(times_2, "<u4", inner_2)],
                    names=["shard", "block", "shards", "ctx", "numbers", "known", "words", "counts", "plain", "numbers_2", "words_2", "counts_2"],
                )
                give_back()

    width = min(max((begin - 1).bit_length(), 1), 32)  # no word has the number of BEGIN

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        asked = [(unpack_numbers(r.ctx).astype(np.uint64), unpack(r.numbers, "<u4").astype(np.int64), unpack_numbers(r.words).astype(np.uint64)) for r in pdf.itertuples()]
        every = np.concatenate([np.repeat(c, n) << np.uint64(32) | w for c, n, w in asked])
        times = np.concatenate([unpack(x, "<u4") for x in pdf["counts"]])
        plain = np.concatenate([unpack(x, "u1") for x in pdf["plain"]])
        trained = times > 0
        pairs, inverse = np.unique(every[trained], return_inverse=True)
        counts = np.bincount(inverse, times[trained], len(pairs)).astype(np.int64)
        likely = np.zeros(len(pairs))
        likely[inverse] = 2.0 ** (plain[trained] / 8) / (total + distinct + 1)
        place = np.full(len(every), -1)
        place[trained] = inverse
        del every, times, plain, inverse
        of = np.repeat(place, np.concatenate([unpack(x, "<u4") for x in pdf["numbers_2"]]))
        words_2 = np.concatenate([unpack_numbers(x) for x in pdf["words_2"]])
        times_2 = np.concatenate([unpack(x, "<u4") for x in pdf["counts_2"]])
        trained = times_2 > 0  # then its first two words are, too
        triples, inverse = np.unique(of[trained].astype(np.uint64) << np.uint64(32) | words_2[trained], return_inverse=True)
        triple_counts = np.bincount(inverse, times_2[trained], len(triples)).astype(np.int64)
        del place, of, words_2, times_2, trained, inverse
        given: dict[int, int] = {}
        for (ctx, _, _), data in zip(asked, pdf["known"], strict=True):
            known = unpack(data, "<u8")
            some = np.flatnonzero(known)
            given.update(zip(ctx[some].tolist(), known[some].tolist(), strict=True))
        with tempfile.TemporaryDirectory() as folder:
            trie = Trie(build_trie(pairs, counts, given, likely, triples, triple_counts, 1 / (total + distinct + 1), width, folder, spread(bits)))
            del pairs, counts, likely, triples, triple_counts
            found = []
            for a, numbers, words in zip(asked, pdf["numbers_2"], pdf["words_2"], strict=True):
                found.append([pack(x) for x in trie.look_up(*a, unpack(numbers, "<u4").astype(np.int64), unpack_numbers(words).astype(np.uint64))])
            hot = trie.hot
            del trie
        give_back()
        out = pdf[["shard", "block"]].assign(**dict(zip(NGRAMS.answers, map(list, zip(*found, strict=True)), strict=True)), hot=None)
        return pd.concat([out, out[:1].assign(block=-1, **{c: b"" for c in NGRAMS.answers}, hot=[hot])]) if hot else out

    return exchange(joined.mapInArrow(ask, QUESTIONS), bits, NGRAMS, answer, ANSWERS)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = 7, held: int = 2) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32(id as text) mod parts is `held` are held out: they are scored, but not
    counted. A text's tokens are its words (runs of other characters than [\\x20\\x09-\\x0D],
    A-Z in lower case) and an end; a null or empty text is its end alone. Repeated rows are
    counted as often as they are there. Without training rows all scores are 0. Empty table:
    no rows. Other columns are ignored. Ids must be integers (else TypeError).
    """
    spark = docs.sparkSession
    table = write_blocks(docs, id_col, text_col)
    bits = shard_bits(table)
    counted = materialize(count_words(table, bits, parts, held), "none")
    sums = counted.agg(F.sum("v"), F.sum("n"), F.max("known")).first()
    distinct, total, begin = sums[0] or 0, sums[1] or 0, (sums[2] or 0) << bits  # no word has the number `begin`
    counts = counted.filter("block >= 0").groupBy("block").agg(F.collect_list(F.struct("shard", "counts", "ranks")).alias("counts"))  # a row per shard at most
    # each exchange is written, so that its shuffle and what it was made of can go before the next
    joined = materialize(table.select("block", "doc_ids", "sizes", "text").join(counts, "block"), "none")
    release(spark, table, counted)
    answers = materialize(ngram_answers(joined, bits, total, distinct, begin, parts, held), "none")
    release(spark)
    parts_of_hot = answers.filter("block < 0").select(F.explode("hot").alias("number", "part")).groupBy("number").agg(F.sum("part").alias("part"))
    of_hot = {r.number: r.part / (WEIGHT * spread(bits) // SPREAD) for r in parts_of_hot.collect()}  # each has 1 / HOT of all tokens, so there are 2 * HOT at most
    answers = answers.filter("block >= 0").groupBy("block").agg(F.collect_list(F.struct("shard", "codes", "weights", "codes_2", "weights_2")).alias("answers"))
    share = np.append(0.0, 10 ** (LEAST + STEP * np.arange(255)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                t = Tokens(row, parts, held)
                counts, ids = word_counts(row, t.words, bits)
                c = Contexts(t, counts, ids, begin, total, bits)
                parts_ = sorted(row["answers"], key=lambda x: x["shard"])
                codes = np.concatenate([unpack(x["codes"], "u1") for x in parts_])
                by_word = c.taken(np.concatenate([unpack(x["weights"], "<u2") for x in parts_]) / WEIGHT, of_hot)
                base = (counts[t.at] + 1) / (total + distinct + 1)
                p = share[codes[c.pair_of]] + (1 - np.minimum(by_word[c.before], 0.999999)) * base
                _, having, triple_of = trigrams(t, c)
                codes_2 = np.concatenate([unpack(x["codes_2"], "u1") for x in parts_])
                taken_2 = np.concatenate([unpack(x["weights_2"], "u1") for x in parts_]) / WEIGHT2
                p[having] = share[codes_2[triple_of]] + (1 - taken_2[c.pair_of[having - 1]]) * p[having]
                sums = lambda x: np.add.reduceat(x, t.starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(~t.training), pa.array(t.n), pa.array(sums((counts[t.at] > 0).astype(np.int64))), pa.array(np.full(len(t.n), total))] + [pa.array(sums(np.log10(x))) for x in (base, p)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )
                give_back()

    return joined.join(answers, "block").mapInArrow(score, SCORES).withColumnRenamed("doc_id", id_col)

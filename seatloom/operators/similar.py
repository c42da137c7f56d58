"""Names that are like other names: q-gram prefixes for edits and rarest words for subsets, without comparing all pairs; fuzzy scores block by block, few pairs of each.

For edits and subsets each distinct name is indexed by pieces (pairs of letters, words), and a name asks by few of its rarest ones: with at most ``e`` of its pieces lost in any name that
is like it, one of any ``e + 1`` is left. Counts of common pieces, places and lengths drop what can't be near enough, and only the rest is measured. Pieces held by
more than ``HOT`` names are dealt over several groups, the names that ask for them going to each.

Null and empty names match nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.functions import names as NM
from seatloom.operators.tables import first_per_key
from seatloom.runtime import materialise

#: A piece that more names hold is dealt out in groups of about so many.
HOT = 10_000
#: Names of one block of fuzzy scores, the least number of blocks of a side, the most tasks that pairs of blocks are dealt to.
BLOCK, BLOCKS, PARTS = 8_192, 4, 512
#: Places that letters are counted in, fewest names that bits of their own are worth, most entries of a table of names and letters.
PLACES, WORTH, TABLE = 64, 256, 1 << 22
#: Letters of a name's beginning that states are kept for, letters whose places in a block are kept.
SHARED, LETTERS = 64, 512


def words(name: Column) -> Column:
    """Distinct words of a name in capitals; commas part words."""
    return F.array_distinct(F.filter(F.split(F.replace(F.upper(name), F.lit(","), F.lit(" ")), r"\s+"), lambda w: w != ""))


def shared(asking: DataFrame, held: DataFrame, hot: int = HOT) -> DataFrame:
    """Rows (a, piece, ...) and (b, piece, ...) joined on the piece, hot pieces dealt by b; ``piece`` is dropped."""
    many = held.groupBy(F.col("piece").alias("m_piece")).agg(F.ceil(F.count("*") / hot).cast("int").alias("groups")).filter("groups > 1")
    groups = F.coalesce("groups", F.lit(1))
    dealt = held.join(many, F.col("piece") == F.col("m_piece"), "left").withColumn("group", F.pmod(F.xxhash64("b"), groups).cast("int")).drop("m_piece", "groups")
    to_all = asking.join(many, F.col("piece") == F.col("m_piece"), "left").withColumn("group", F.explode(F.sequence(F.lit(0), groups - 1))).drop("m_piece", "groups")
    return to_all.join(dealt, ["piece", "group"]).drop("piece", "group")


def subset_pairs(left: DataFrame, right: DataFrame, least: int = 2, hot: int = HOT) -> DataFrame:
    """Names (a) and names (b) -> a, b: all words of a, at least ``least``, are words of b.

    A name asks by its rarest word alone, so a pair comes up once; a word that no b holds ends the search.
    """
    asking = left.select("a", words(F.col("a")).alias("w")).distinct().filter(F.size("w") >= least)
    known = right.select("b", words(F.col("b")).alias("v")).distinct().filter(F.size("v") >= least)
    held = materialise(known.select("b", "v", F.explode("v").alias("piece")), "held-words")
    count = held.groupBy(F.col("piece").alias("c_piece")).agg(F.count("*").alias("n"))
    each = asking.select("a", "w", F.explode("w").alias("piece")).join(count, F.col("piece") == F.col("c_piece"), "left")
    rarest = each.groupBy("a", "w").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("r"))
    pairs = shared(rarest.filter("r.n > 0").select("a", "w", F.col("r.piece").alias("piece")), held, hot)
    return pairs.filter(F.size(F.array_except("w", "v")) == 0).select("a", "b")


def pairs_of_letters(text: Column) -> Column:
    """Each pair of neighbouring letters with its place: structs of piece and at. Equal pairs aren't numbered: an edit would number all later ones anew."""
    n = F.length(text)
    each = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.struct(F.substring(text, i, F.lit(2)).alias("piece"), i.alias("at")))
    return F.when(n >= 2, each).otherwise(F.array().cast("array<struct<piece:string,at:int>>"))


def rarest(pieces: DataFrame, name: str, many: Column) -> DataFrame:
    """Rows (name, piece, ...) -> the ``many`` rarest pieces of each name, by the number of names that hold them."""
    count = pieces.groupBy(F.col("piece").alias("c_piece")).agg(F.count("*").alias("n"))
    rest = [c for c in pieces.columns if c != name]
    told = pieces.join(count, F.col("piece") == F.col("c_piece")).groupBy(name).agg(F.sort_array(F.collect_list(F.struct("n", *rest))).alias("p"))  # as long as a name
    first = told.select(name, F.explode("p").alias("x")) if many is None else told.select(name, F.explode(F.slice("p", F.lit(1), many)).alias("x"))
    return first.select(name, *[F.col("x")[c].alias(c) for c in rest])


def within_edits(left: DataFrame, right: DataFrame, most: int = 2, hot: int = HOT) -> DataFrame:
    """Names (a) and names (b) -> a, b, edits: all pairs of at most ``most`` insertions, deletions and replacements of letters.

    Each edit changes at most two pairs of letters, so one of any ``2 * most + 1`` is left, at most ``most`` places away, and the first that is left, by rareness, pair
    and place, is among so many of both names. Names that are too short for that meet by what is left of them after up to ``most`` deletions.
    """
    lost = 2 * most
    sides = [df.select(F.col(c).alias("name")).filter(F.col(c) != "").distinct().withColumn("side", F.lit(c)) for df, c in ((left, "a"), (right, "b"))]
    names = materialise(sides[0].unionByName(sides[1]).groupBy("name").agg(F.collect_set("side").alias("sides")), "names")
    long = names.filter(F.length("name") > lost + 1).select("name", F.explode(pairs_of_letters(F.col("name"))).alias("p")).select("name", "p.piece", "p.at")
    prefix = materialise(rarest(long, "name", F.lit(lost + 1)).join(names, "name").withColumn("size", F.length("name")), "prefixes")
    # two names of which one is short have both at most this many letters
    short = names.filter(F.length("name") <= lost + 1 + most).withColumn("left", F.array("name"))
    for _ in range(most):
        cut = F.flatten(F.transform("left", lambda t: F.transform(F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substr(t, i + 1)))))
        short = short.withColumn("left", F.array_distinct(F.concat("left", cut)))
    short = materialise(short.select("name", "sides", F.explode("left").alias("piece")), "short-names")
    of = lambda df, side, *rest: df.filter(F.array_contains("sides", side)).select(F.col("name").alias(side), "piece", *[F.col(c).alias(f"{c}_{side}") for c in rest])
    near = shared(of(prefix, "a", "at", "size"), of(prefix, "b", "at", "size"), hot).filter((F.abs(F.col("at_a") - F.col("at_b")) <= most) & (F.abs(F.col("size_a") - F.col("size_b")) <= most))
    pairs = near.select("a", "b").unionByName(shared(of(short, "a"), of(short, "b"), hot).select("a", "b")).distinct()
    return pairs.withColumn("edits", F.levenshtein("a", "b", most)).filter("edits >= 0")


def nearest(left: DataFrame, right: DataFrame, most: int = 2, hot: int = HOT) -> DataFrame:
    """Names (a) -> a, b, edits: the name of fewest edits, the first of equals; only names that have one."""
    return first_per_key(within_edits(left, right, most, hot), ["a"], [F.col("edits"), F.col("b")])


class _Coded:
    """Texts as numbers of letters (0: none), and their sizes."""

    def __init__(self, texts: list[str], letters: dict[str, int]):
        self.letters, self.size = letters, np.array([len(t) for t in texts], np.int64)
        self.codes = np.zeros((len(texts), int(self.size.max(initial=0))), np.int32)
        for row, t in zip(self.codes, texts, strict=True):
            row[: len(t)] = [letters.setdefault(c, len(letters) + 1) for c in t]
        self.kind = np.uint32 if self.size.max(initial=0) <= 32 else np.uint64
        self.table: np.ndarray | None = None

    def hits(self, i: np.ndarray, other: _Coded, j: np.ndarray) -> np.ndarray:
        """For each letter of the other texts (rows) and each pair: the places of these texts, of at most 64 letters, that hold it, as bits."""
        t = other.codes[j][:, : int(other.size[j].max(initial=0))].T
        if len(self.size) * (len(self.letters) + 1) <= TABLE:
            if self.table is None:
                self.table = np.zeros((len(self.size), len(self.letters) + 1), self.kind)
                for place, letter in enumerate(self.codes.T[:64]):
                    own = np.flatnonzero(letter)
                    self.table[own, letter[own]] |= self.kind(1 << place)
            return self.table[i[None, :], t]
        out = np.zeros(t.shape, self.kind)
        for place, letter in enumerate(self.codes[i][:, : int(self.size[i].max(initial=0))].T):
            out |= (np.where(letter > 0, letter, -1) == t).astype(self.kind) << self.kind(place)
        return out


class _Texts:
    """Names of one block in the form that ``names.likeness`` compares, whole and as sorted distinct words, as numbers of letters (0: none)."""

    def __init__(self, names: list[str], letters: dict[str, int], words: dict[str, int]):
        self.texts = [" ".join(t.upper().replace(",", " ").split()) for t in names]
        parts = [sorted(set(t.split())) for t in self.texts]
        self.sorted_texts = [" ".join(p) for p in parts]
        self.whole = _Coded(self.texts, letters)
        self.sorted = _Coded(self.sorted_texts, letters)
        self.words = np.zeros((len(parts), max(map(len, parts), default=1)), np.int64)
        for row, p in zip(self.words, parts, strict=True):
            row[: len(p)] = [words.setdefault(w, len(words) + 1) for w in p]
        self.word_sizes = np.where(self.words > 0, 0, -1)
        for row, p in zip(self.word_sizes, parts, strict=True):
            row[: len(p)] = [len(w) for w in p]
        # how often letters stand in the sorted words; letters that share a place only add to what is in common
        self.counts = np.zeros((len(parts), PLACES), np.uint8)
        own, at = np.nonzero(self.sorted.codes)
        np.add.at(self.counts, (own, self.sorted.codes[own, at] % PLACES), 1) if self.sorted.size.max(initial=0) <= 255 else self.counts.fill(255)

    def repeats(self, counted: dict[tuple[str, int], int], some: np.ndarray) -> list[list[int]]:
        """Each letter with its number among equal ones, so common ones count as often as both texts have them."""
        return [[counted.setdefault((c, k), len(counted)) for c, n in Counter(self.texts[i]).items() for k in range(n)] for i in some]


def _incidence(repeats: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(repeats), width), np.float32)
    for row, h in zip(out, repeats, strict=True):
        row[h] = 1
    return out


def _lcs(short: _Coded, i: np.ndarray, long: _Coded, j: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of pairs, bit by bit; short texts of 1 to 64 letters. Bits beyond a text stay set."""
    row = np.full(len(i), ~short.kind(0))
    for hit in short.hits(i, long, j):
        hit &= row
        row = (row + hit) | (row - hit)
    return np.bitwise_count(~row).astype(np.int64)


def _partial(short: _Coded, i: np.ndarray, long: _Coded, j: np.ndarray, need: float) -> np.ndarray:
    """Largest ratio of each short text to a stretch of the long one of at most its length, by ``names.likeness``; 0 where less than ``need`` of it is in the long one."""
    out, kind = np.zeros(len(i)), short.kind
    for n in np.unique(short.size[i]):
        own = np.flatnonzero(short.size[i] == n)
        own = own[_lcs(short, i[own], long, j[own]) >= n * need - 1e-9]
        if not len(own):
            continue
        hits, m = short.hits(i[own], long, j[own]), long.size[j[own]]
        best = np.zeros(len(own))
        hits = np.concatenate([hits, np.zeros((n, len(own)), kind)])
        for start in range(int(m.max())):
            row = np.full(len(own), ~kind(0))
            for k in range(n):
                hit = hits[start + k] & row
                row = (row + hit) | (row - hit)
                if start == 0 or k == n - 1:
                    size = np.minimum(k + 1, m - start)
                    ratio = 200 * np.bitwise_count(~row).astype(np.int64) / (n + np.maximum(size, 0))
                    best = np.maximum(best, np.where(size > 0, ratio, 0))
        out[own] = best
    return out


def _held(a: _Texts, b: _Texts, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Letters of the words that pairs have in common, with a blank for each."""
    held = np.zeros(len(i), np.int64)
    for c, size in zip(a.words.T, a.word_sizes.T, strict=True):
        for d in b.words.T:
            held += ((c[i] == d[j]) & (c[i] > 0)) * (size[i] + 1)
    return held


def _token_bound(a: _Texts, b: _Texts, i: np.ndarray, j: np.ndarray, held: np.ndarray) -> np.ndarray:
    """At least the token-set ratio, from the letters that the sorted words have in common."""
    x, y, out = a.sorted.size[i], b.sorted.size[j], np.zeros(len(i))
    for k in range(0, len(i), 1 << 15):
        part = slice(k, k + (1 << 15))
        common = np.minimum(a.counts[i[part]], b.counts[j[part]]).sum(axis=1, dtype=np.int64)
        # texts whose letters aren't counted have all in common
        out[part] = np.minimum(np.where((x[part] > 255) | (y[part] > 255), x[part], common), np.minimum(x[part], y[part]))
    both = np.maximum(held - 1, 0)
    out = np.maximum(200 * out / (x + y), 200 * both / (both + np.minimum(x, y)))
    return np.where((held > 0) & (both >= np.minimum(x, y)), 100, out)


def _scores(a: _Texts, b: _Texts, i: np.ndarray, j: np.ndarray, least: int, by_words: bool = True, by_letters: bool = True) -> np.ndarray:
    """``names.likeness`` of pairs of texts where it is at least ``least``; 0 or less than that elsewhere.

    Without ``by_letters`` only what common words give, without ``by_words`` all but that.
    """
    s, out = least - 0.5, np.zeros(len(i), np.int64)  # scores are rounded
    need = s / (200 - s)
    x, y = a.whole.size[i], b.whole.size[j]
    long, held = np.minimum(x, y) > 64, _held(a, b, i, j)
    both = (held > 0) & ~long
    if by_words:
        can = np.flatnonzero(both)
        for k in can[_token_bound(a, b, i[can], j[can], held[can]) >= s - 1e-9]:
            out[k] = max(out[k], round(NM._token_set(a.texts[i[k]], b.texts[j[k]])))
    if by_letters:
        at = np.flatnonzero(~long & (x <= y))
        out[at] = np.maximum(out[at], np.rint(_partial(a.whole, i[at], b.whole, j[at], need)).astype(np.int64))
        at = np.flatnonzero(~long & (x > y))
        out[at] = np.maximum(out[at], np.rint(_partial(b.whole, j[at], a.whole, i[at], need)).astype(np.int64))
        x, y = a.sorted.size[i], b.sorted.size[j]
        alone = ~both & ~long & (200 * np.minimum(x, y) / (x + y) >= s - 1e-9)
        at = np.flatnonzero(alone & (x <= 64))
        out[at] = np.maximum(out[at], np.rint(200 * _lcs(a.sorted, i[at], b.sorted, j[at]) / (x[at] + y[at])).astype(np.int64))
        # long ones: some pairs, one by one
        for k in np.flatnonzero(alone & (x > 64)):
            out[k] = max(out[k], round(NM._token_set(a.texts[i[k]], b.texts[j[k]])))
        for k in np.flatnonzero(long):
            out[k] = NM.likeness(a.texts[i[k]], b.texts[j[k]])
    for k in np.flatnonzero(out >= least):
        if a.texts[i[k]] in b.texts[j[k]] or b.texts[j[k]] in a.texts[i[k]]:
            out[k] = 95
    return out


class _Bits:
    """Texts of at most 64 letters side by side, a word of bits each: longest common subsequences with one text after another, for all of them at once.

    A state has a zero for each letter of a text that the subsequence takes, so zeros among the first w bits are its length with the first w letters.
    """

    def __init__(self, coded: _Coded, at: np.ndarray, letters: dict[str, int], backwards: bool = False):
        self.at, self.size, self.letters, self.step = at, coded.size[at], letters, -1 if backwards else 1
        self.kind = np.uint32 if self.size.max(initial=0) <= 32 else np.uint64
        own, place = np.nonzero(coded.codes[at])
        letter = coded.codes[at][own, place]
        order = np.argsort(letter, kind="stable")
        self.letter, self.own = letter[order], own[order]
        self.bit = self.kind(1) << (self.size[own] - 1 - place if backwards else place)[order].astype(self.kind)
        self.masks: dict[str, np.ndarray | None] = {}

    def mask(self, letter: str) -> np.ndarray | None:
        """Where each text has the letter; none if no text has it."""
        if letter not in self.masks:
            if len(self.masks) >= LETTERS:
                self.masks.clear()
            first, last = np.searchsorted(self.letter, self.letters.get(letter, -1), "left"), np.searchsorted(self.letter, self.letters.get(letter, -1), "right")
            found = np.zeros(len(self.at), self.kind) if last > first else None
            if last > first:
                np.bitwise_or.at(found, self.own[first:last], self.bit[first:last])
            self.masks[letter] = found
        return self.masks[letter]

    def states(self, texts: list[str], some: list[int]) -> Iterator[tuple[int, np.ndarray]]:
        """The zeros of the states after each of some texts, as ones. Texts that begin alike share the states up to there."""
        state, spare, before = [np.full(len(self.at), ~self.kind(0))], [], ""
        hit, zeros = np.empty_like(state[0]), np.empty_like(state[0])
        for text, i in sorted((texts[i][:: self.step], i) for i in some):
            same = 0
            for x, y in zip(text[:SHARED], before, strict=False):
                if x != y:
                    break
                same += 1
            del state[same + 1 :]
            row = state[same]
            for k, letter in enumerate(text[same:], same):
                if (mask := self.mask(letter)) is not None:
                    place = k if k < SHARED else SHARED + k % 2  # what isn't shared needs no place of its own
                    while len(spare) <= place:
                        spare.append(np.empty_like(hit))
                    np.bitwise_and(row, mask, out=hit)
                    new = np.add(row, hit, out=spare[place])
                    np.subtract(row, hit, out=hit)
                    row = np.bitwise_or(new, hit, out=new)
                if k < SHARED:
                    state.append(row)
            before = text
            yield i, np.invert(row, out=zeros)


class _Candidates:
    """The pairs of two lists of names that can score as much as is asked of a name of the first.

    The shorter text's ratio to a stretch of its own length takes s of its letters in common, to a shorter stretch, which stands at an end, fewer, but of that end.
    Sorted words without a common one need a subsequence by their lengths; names with a common word are found by it.
    """

    def __init__(self, a: _Texts, b: _Texts, letters: dict[str, int], words: int, least: int):
        self.a, self.b, self.least = a, b, least
        size = b.whole.size
        kinds = [np.flatnonzero((size > 0) & (size <= 32)), np.flatnonzero((size > 32) & (size <= 64))]
        self.bits = [[_Bits(coded, at, letters, backwards) for at in kinds if len(at) >= WORTH] for coded, backwards in ((b.whole, False), (b.whole, True), (b.sorted, False))]
        self.others = np.concatenate([at for at in (*kinds, np.flatnonzero(size > 64)) if len(at) < WORTH or size[at[0]] > 64]) if len(size) else size
        # as many letters of the shorter text, its repeated words but once, as its longest common subsequence with a stretch of the other must have
        if len(self.others):
            counted: dict[tuple[str, int], int] = {}
            repeats = [t.repeats(counted, some) for t, some in ((a, range(len(a.texts))), (b, self.others))]
            self.x, self.y = (_incidence(r, len(counted)) for r in repeats)
        # names of b by word
        rows, column = np.nonzero(b.words)
        word = b.words[rows, column]
        order = np.argsort(word, kind="stable")
        self.by_word = rows[order]
        self.start, self.stop = (np.searchsorted(word[order], np.arange(words + 1), side) for side in ("left", "right"))

    def with_common_words(self, some: range) -> np.ndarray:
        """Pairs with a common word of which the token-set ratio can do, as numbers."""
        a, b, width = self.a, self.b, len(self.b.texts)
        rows, column = np.nonzero(a.words[some.start : some.stop])
        word = a.words[some.start : some.stop][rows, column]
        many = self.stop[word] - self.start[word]
        places = np.repeat(self.start[word] - np.cumsum(many) + many, many) + np.arange(many.sum())
        numbers, back = np.unique(np.repeat((rows + some.start) * width, many) + self.by_word[places], return_inverse=True)
        held = np.bincount(back, np.repeat(a.word_sizes[some.start : some.stop][rows, column] + 1, many), len(numbers)).astype(np.int64)
        return numbers[_token_bound(a, b, numbers // width, numbers % width, held) >= self.least - 0.5 - 1e-9]

    def without(self, some: list[int], asked: np.ndarray) -> np.ndarray:
        """Pairs of some names that can score ``asked`` but for common words, as numbers, each once."""
        a, b, width, found = self.a, self.b, len(self.b.texts), [np.zeros(0, np.int64)]
        if len(self.others) and some:
            need = (self.least - 0.5) / (200 - (self.least - 0.5))
            i, j = np.nonzero(self.x[some] @ self.y.T >= need * np.minimum(a.sorted.size[some, None], b.sorted.size[None, self.others]) - 1e-3)
            found.append(np.array(some)[i] * width + self.others[j])
        for kind, kinds in enumerate(self.bits):
            texts = a.sorted_texts if kind == 2 else a.texts
            for bits in kinds:
                size, thresholds = (b.sorted if kind == 2 else b.whole).size[bits.at], {}
                for i, zeros in bits.states(texts, some):
                    n, s = len(texts[i]), (asked[i] - 0.5) / 100
                    need, at_end = s / (2 - s), kind < 2 and n <= 64
                    if kind != 1:
                        if (n, s) not in thresholds:
                            least = s / 2 * (size + n) if kind == 2 else np.where((size >= n) & at_end, s * n, need * np.minimum(size, n))
                            thresholds[n, s] = np.minimum(np.ceil(least - 1e-9), 255).astype(np.uint8)
                        found.append(i * width + bits.at[np.flatnonzero(np.bitwise_count(zeros) >= thresholds[n, s])])
                    if at_end:  # else the other text is the shorter one
                        zeros &= bits.kind(min((1 << n - 1) - 1, np.iinfo(bits.kind).max))
                        found.append(i * width + bits.at[np.flatnonzero(np.bitwise_count(zeros) >= np.uint8(np.ceil(need * n - 1e-9)))])
        return np.unique(np.concatenate(found))


def _alike_in_block(left: list[str], right: list[str], least: int, strip: int = 1 << 23, chunk: int = 1 << 15, top: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in both lists and scores of the pairs that score at least ``least``, each once; a strip of pairs after another.

    ``top``: what each name of the left list has found so far, kept by the caller; then pairs below that may be left out, and a pair may come with what its common
    words give before it comes with its score.
    """
    letters, words = {}, {}
    order = np.array(sorted(range(len(left)), key=lambda i: left[i].upper()), np.int64)  # names that begin alike are judged together
    a, b = (_Texts(names, letters, words) for names in ([left[i] for i in order], right))
    candidates, width = _Candidates(a, b, letters, len(words), least), len(right)

    def scored(numbers: np.ndarray, **parts: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for k in range(0, len(numbers), chunk):
            i, j = np.divmod(numbers[k : k + chunk], width)
            score = _scores(a, b, i, j, least, **parts)
            found = score >= least
            yield order[i[found]], j[found], score[found]

    height = max(1, strip // max(1, width))
    for first in range(0, len(left), height):
        some = range(first, min(first + height, len(left)))
        told = candidates.with_common_words(some)
        if top is None:
            yield from scored(np.union1d(told, candidates.without([i for i in some if a.texts[i]], np.full(len(left), least))))
            continue
        yield from scored(told, by_letters=False)
        asked = np.maximum(top[order], least)
        # 100 is by common words alone, if a text is not so long that less is rounded up
        yield from scored(candidates.without([i for i in some if a.texts[i] and (asked[i] < 100 or len(a.texts[i]) > 64)], asked), by_words=False)


def _best_in_block(left: list[str], right: list[str], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each name's best: places in both lists and scores, of equals the first name."""
    place = np.empty(len(right), np.int64)
    place[sorted(range(len(right)), key=right.__getitem__)] = np.arange(len(right))
    at, top = np.full(len(left), -1, np.int64), np.zeros(len(left), np.int64)
    for i, j, score in _alike_in_block(left, right, least, top=top):
        order = np.lexsort((place[j], -score, i))
        first = order[np.append(True, i[order][1:] != i[order][:-1])] if len(order) else order
        i, j, score = i[first], j[first], score[first]
        better = (score > top[i]) | ((score == top[i]) & (place[j] < place[at[i]]))
        at[i[better]], top[i[better]] = j[better], score[better]
    found = np.flatnonzero(at >= 0)
    return found, at[found], top[found]


def _every_in_block(left: list[str], right: list[str], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    none = (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(none, *_alike_in_block(left, right, least), strict=True))


def _judged(left: DataFrame, right: DataFrame, least: int, block: int, judge: Callable[[list[str], list[str], int], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """Names of both sides in blocks -> a, b, score by ``judge`` for each pair of blocks, where both meet."""
    if not 80 <= least <= 100:
        raise ValueError("least must be 80 to 100")
    blank = F.trim(F.regexp_replace(F.col("name"), r"[,\s]+", " ")) == ""
    told = {s: materialise(df.select(F.col(s).alias("name")).filter(F.col("name").isNotNull() & ~blank).distinct(), f"names-{s}") for s, df in (("a", left), ("b", right))}
    many = {s: max(BLOCKS, -(-df.count() // block)) for s, df in told.items()}
    own = lambda s: F.pmod(F.xxhash64("name"), F.lit(many[s])).cast("int")
    every = lambda s: F.explode(F.sequence(F.lit(0), F.lit(many[s] - 1)))
    parts = min(many["a"] * many["b"], PARTS)
    dealt = {
        "a": told["a"].withColumn("i", own("a")).withColumn("j", every("b")).repartition(parts, "i", "j"),
        "b": told["b"].withColumn("j", own("b")).withColumn("i", every("a")).repartition(parts, "i", "j"),
    }

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        a, b = x.column("name").to_pylist(), y.column("name").to_pylist()
        i, j, score = judge(a, b, least) if a and b else (np.zeros(0, np.int64),) * 3
        return pa.table({"a": pa.array([a[k] for k in i], pa.string()), "b": pa.array([b[k] for k in j], pa.string()), "score": pa.array(score, pa.int32())})

    return dealt["a"].groupBy("i", "j").cogroup(dealt["b"].groupBy("i", "j")).applyInArrow(run, "a string, b string, score int")


def alike(left: DataFrame, right: DataFrame, least: int = 90, block: int = BLOCK) -> DataFrame:
    """Names (a) and names (b) -> a, b, score: all pairs of a fuzzy score (``names.likeness``) of at least ``least``, which is 80 or more.

    Names of each side are dealt into blocks of about ``block``; each pair of blocks is judged where both meet, and pairs are never shuffled. Longest common
    subsequences of one name with all of a block at once, bit by bit, drop nearly all pairs. So work still grows with the product of both sides, at some tens of
    nanoseconds a pair.
    """
    return _judged(left, right, least, block, _every_in_block)


def best_alike(left: DataFrame, right: DataFrame, least: int = 90, block: int = BLOCK) -> DataFrame:
    """Names (a) -> a, b, score: the best name of at least ``least``, the first of equals; only names that have one."""
    return first_per_key(_judged(left, right, least, block, _best_in_block), ["a"], [F.desc("score"), F.col("b")])

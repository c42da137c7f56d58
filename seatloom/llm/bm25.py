"""BM25 pieces shared by the search operators: terms, term weights, and postings in blocks with their maxima.

Scores are whole numbers (millionths), so sums don't depend on their order and ties are exact. They are held as floats, which
count whole numbers exactly far beyond any score.
"""

from __future__ import annotations

import re

import numpy as np

K1, B = 1.2, 0.75
#: Postings are bounded by a maximum for each aligned range of so many documents.
BLOCK = 64
SCALE = 1_000_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a whole text: runs of letters, digits and non-ASCII characters, A-Z lower-cased; none for null."""
    return _TERM.findall((text or b"").translate(_LOWER))


def idf(n_docs: int, df: np.ndarray) -> np.ndarray:
    """Inverse document frequency in millionths."""
    df = np.asarray(df, float)
    return np.floor(np.log(1 + (n_docs - df + 0.5) / (df + 0.5)) * SCALE).astype(np.int64)


def saturation(tf: np.ndarray, length: np.ndarray, mean_length: float) -> np.ndarray:
    """Saturated term frequency. A posting's share of the score is ``floor(weight * saturation)``."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))


def spread(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The numbers of all ranges start .. stop - 1, one range after another."""
    sizes = stop - start
    return np.repeat(start - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class Lists:
    """Posting lists one after another (documents ascending in each) with a maximum for each block of each list."""

    def __init__(self, sizes: np.ndarray, docs: np.ndarray, saturations: np.ndarray, n_docs: int):
        self.n_docs, self.n_blocks = n_docs, -(-n_docs // BLOCK)
        self.docs, self.saturations = docs, saturations
        self.stop = np.cumsum(sizes, dtype=np.int64)
        self.start = self.stop - sizes
        block = docs // BLOCK
        new = np.ones(len(docs), bool)
        new[1:] = block[1:] != block[:-1]
        new[self.start] = True
        #: first posting of each block of each list, and one past its last
        self.first = np.flatnonzero(new)
        self.last = np.append(self.first[1:], len(docs))
        self.block = block[self.first]
        self.most = np.maximum.reduceat(saturations, self.first) if len(docs) else saturations
        self.head, self.tail = np.searchsorted(self.first, self.start), np.searchsorted(self.first, self.stop)
        self.top = np.maximum.reduceat(self.most, self.head) if len(docs) else saturations

    def bounds(self, lists: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sum of the lists' block maxima for each block: no document of it can score more."""
        at = spread(self.head[lists], self.tail[lists])
        share = np.floor(np.repeat(weights, self.tail[lists] - self.head[lists]) * self.most[at])
        return np.bincount(self.block[at], share, self.n_blocks)

    def within(self, lists: np.ndarray, weights: np.ndarray, live: np.ndarray, left: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Documents and score shares of the lists' postings in live blocks (a mark for each block), of documents that are ``left`` (likewise)."""
        at = spread(self.head[lists], self.tail[lists])
        inside = live[self.block[at]]
        weight = np.repeat(weights, self.tail[lists] - self.head[lists])[inside]
        at = at[inside]
        posts = spread(self.first[at], self.last[at])
        weight = np.repeat(weight, self.last[at] - self.first[at])
        docs = self.docs[posts]
        if left is not None:
            some = left[docs]
            docs, posts, weight = docs[some], posts[some], weight[some]
        return docs, np.floor(weight * self.saturations[posts])


def best_of(docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best by score, then by smaller number."""
    if len(docs) > 4 * k:
        # only what can be among the k best is sorted
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        docs, scores = docs[keep], scores[keep]
    order = np.lexsort((docs, -scores))[:k]
    return docs[order], scores[order]


class Searcher:
    """Block-max WAND over the lists of one shard.

    The rule of the pivot is applied to all documents at once: of the lists in order of their maxima, those before the pivot can't
    reach the floor together, so a document must stand in one from the pivot on; only blocks whose maxima reach the floor are opened. Then the
    pivot moves down, and documents are left whose share so far and the maxima that their block has in the lists before the pivot reach the
    floor; only their postings are scored. The last few are scored in full, from the forward order of the same postings.
    ``scored`` counts the postings that were scored, ``asked`` those asked for.
    """

    def __init__(self, lists: Lists, forward: np.ndarray):
        self.lists, self.scored, self.asked = lists, 0, 0
        sizes = np.bincount(lists.docs, minlength=lists.n_docs)
        self.stop = np.cumsum(sizes)
        self.start = self.stop - sizes
        self.mean_terms = len(lists.docs) / max(lists.n_docs, 1)
        self.terms = np.repeat(np.arange(len(lists.start), dtype=np.int32), lists.stop - lists.start)[forward]
        self.saturations = lists.saturations[forward]
        self.weight = np.zeros(len(lists.start))

    def full(self, docs: np.ndarray) -> np.ndarray:
        """Scores of documents under the weights that are set."""
        at = spread(self.start[docs], self.stop[docs])
        self.scored += len(at)
        owner = np.repeat(np.arange(len(docs)), self.stop[docs] - self.start[docs])
        return np.bincount(owner, np.floor(self.weight[self.terms[at]] * self.saturations[at]), len(docs))

    def top_k(self, lists: np.ndarray, weights: np.ndarray, k: int, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents, ties by the smaller number; documents below ``floor`` may be left out."""
        none = np.zeros(0, np.int64), np.zeros(0)
        own = self.lists
        most = np.floor(weights * own.top[lists])
        self.asked += int((own.stop[lists] - own.start[lists]).sum())
        if not len(lists) or most.sum() < floor:
            return none
        self.weight[lists] = weights
        bounds = own.bounds(lists, weights)
        if floor <= 0 and own.n_docs > 8 * BLOCK:
            # the documents of the best blocks give a first floor
            blocks = np.argsort(-bounds, kind="stable")[: 1 + k // BLOCK + 1]
            docs = spread(blocks * BLOCK, np.minimum((blocks + 1) * BLOCK, own.n_docs))
            scores = np.sort(self.full(docs))
            floor = max(floor, scores[-k]) if len(scores) >= k else floor
        live = bounds >= floor
        order = np.argsort(most, kind="stable")
        pivot = int(np.searchsorted(np.cumsum(most[order]), floor, "left")) if floor > 0 else 0
        docs, shares = own.within(lists[order[pivot:]], weights[order[pivot:]], live)
        self.scored += len(docs)
        seen = np.zeros(own.n_docs, bool)
        seen[docs] = True
        scores, found = np.bincount(docs, shares, own.n_docs), np.flatnonzero(seen)
        cumulated = np.cumsum(most[order])
        while True:
            reach = scores[found]
            if pivot:
                reach = reach + own.bounds(lists[order[:pivot]], weights[order[:pivot]])[found // BLOCK]
            keep = reach >= floor
            found, reach = found[keep], reach[keep]
            before = lists[order[:pivot]]
            # a few documents are cheaper in full than the lists that are left
            if not pivot or self.mean_terms * len(found) < 0.2 * (own.stop[before] - own.start[before]).sum():
                break
            # the next lists, with half of what is left to add, for the documents that are left
            following = int(np.searchsorted(cumulated[:pivot], cumulated[pivot - 1] / 2, "left"))
            live, left = np.zeros(own.n_blocks, bool), np.zeros(own.n_docs, bool)
            live[found // BLOCK], left[found] = True, True
            docs, shares = own.within(lists[order[following:pivot]], weights[order[following:pivot]], live, left)
            self.scored += len(docs)
            scores += np.bincount(docs, shares, own.n_docs)
            pivot = following
        if not pivot:
            best = best_of(found, reach, k)
        else:
            best, at, step = none, 0, max(4 * k, 64)
            order = np.argsort(-reach, kind="stable")
            found, reach = found[order], reach[order]
            while at < len(found) and reach[at] >= floor:
                part = found[at : at + step]
                part = part[reach[at : at + step] >= floor]
                best = best_of(np.concatenate([best[0], part]), np.concatenate([best[1], self.full(part)]), k)
                floor = max(floor, best[1][-1]) if len(best[1]) == k else floor
                at, step = at + step, step * 2
        self.weight[lists] = 0
        return best


def above(lists: Lists, chosen: np.ndarray, weights: np.ndarray, thresholds: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block-max WAND for thresholds: all documents that score at least their own threshold, and the scores.

    ``least`` has the least threshold of each block; a block whose maxima are below it is skipped.
    """
    live = lists.bounds(chosen, weights) >= least
    if not live.any():
        return np.zeros(0, np.int64), np.zeros(0)
    docs, shares = lists.within(chosen, weights, live)
    scores = np.bincount(docs, shares, lists.n_docs)
    found = np.unique(docs)
    found = found[scores[found] >= thresholds[found]]
    return found, scores[found]

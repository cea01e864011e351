"""Exact top-k search with BM25, by block-max WAND over shards of an inverted index.

A partition of the documents is a shard; it is indexed in segments (parts of its Arrow
batches), and the best k of every query and their least score, the threshold, go from segment
to segment.  A segment's documents are put in blocks of documents that share frequent terms; the
list of a term has an entry for each block that holds it, with the block's greatest impact.

Each query walks with a cursor in the list of each of its terms.  In the order of the cursors' blocks the
terms' greatest impacts are added until they reach the threshold: that block is the pivot, and all
before it are passed over.  If the block maxima of the terms that are in the pivot reach the threshold too,
postings of its rare terms are read, document by document for all queries at once, and where these and the block maxima of frequent terms still
reach it the block's documents are scored, which lifts the threshold; then the cursors go behind it.
Blocks are the same for all terms, and queries that are searched together walk in step, so cursors
that lie at or behind the least pivot are the same for all of them and are kept once; those of
frequent terms are read in a table of the next block with each term.

Thresholds start from a ladder of samples: the sample of one in SAMPLE_STEP documents is
searched first, with thresholds from the sample of one in SAMPLE_STEP of it, and so on.  A
subset's k-th score never exceeds that of the whole, which keeps the search exact, and a
query's rows out of all shards are about k x SAMPLE_STEP, however many shards there are.

Global statistics are the number of documents, their mean length, and the document
frequency of every query term, counted over all documents in one pass for COUNTED_TERMS distinct terms.
Queries are a stated set and go to the shards in blocks of at most QUERY_POSTINGS (query, term) pairs, one pass each.

A term is a lower-cased run of letters and digits; a query counts each of its terms once.
score = sum of log(1 + (N - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean)).

Defined cases: null and empty texts are never found and find nothing; a document that holds
no query term is not returned, so a query may have fewer than k rows; equal scores (to 9
decimals) rank by key, null keys last; repeated rows are separate documents, and rows of
queries with one key are separate queries with equal rows; empty tables give no rows; other
columns are not returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stenoflow.llm import bytesets as B
from stenoflow.llm import common as C

K = 10
K1, B_LENGTH = 1.2, 0.75
#: Documents per block of the index.
BLOCK = 256
#: (query, term) pairs that go to the shards at once, at most about.
QUERY_POSTINGS = 8_000_000
#: Distinct query terms that are counted in one pass over all documents, at least.
COUNTED_TERMS = 4_000_000
#: Each sample of the ladder is one in so many documents of the next, down to SAMPLE_LEAST.
SAMPLE_STEP = 8
SAMPLE_LEAST = 4_000
#: Share of a score that sums of 32-bit floats may be off by; scores returned are of 64 bits.
SLACK = 1e-4
#: Bytes of text in a segment, and queries searched in it together, at most about.
SEGMENT_BYTES = 32 << 20
TOGETHER = 4096
#: Sums of rare terms that are made at once, about.
STEP = 1 << 15
#: Terms in more than this share of a segment's documents are frequent, as long as their table
#: has room; this bounds memory and changes no result.
FREQUENT, DENSE_CELLS = 1 / 16, 12_000_000
#: The most frequent terms, by which documents are put in blocks.
ALIKE = 256

_TABLE = B.byte_table(True, B.ALNUM)


def terms_of(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, _, h = B.words(buf, offsets, B.ALNUM, _TABLE)
    return h, B.row_bounds(starts, offsets)


def _query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, terms): the distinct terms of every query, as sorted 64-bit hashes."""
    for batch in batches:
        buf, offsets = B.utf8(batch.column("text"))
        out = []
        for i in range(batch.num_rows):
            part = buf[offsets[i] : offsets[i + 1]]
            out.append(np.unique(terms_of(part, np.array([0, len(part)]))[0]).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.binary())], names=["key", "terms"])


class Queries:
    """A block of queries: the sorted terms, and every query's places in them."""

    def __init__(self, hashes: list[np.ndarray]):
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.terms, at = np.unique(flat, return_inverse=True)
        self.at = at.astype(np.int32)
        self.bounds = np.cumsum([0] + [len(h) for h in hashes])

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def of(self, q: int) -> np.ndarray:
        return self.at[self.bounds[q] : self.bounds[q + 1]].astype(np.int64)


class Places:
    """Which hashes are query terms, and where: terms are looked up by their first bits, those that share them one after another."""

    BITS = 22

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        bucket = (terms >> np.uint64(64 - self.BITS)).astype(np.int64)
        self.first = np.searchsorted(bucket, np.arange((1 << self.BITS) + 1)).astype(np.int32)

    def __call__(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bucket = (h >> np.uint64(64 - self.BITS)).astype(np.int32)
        place, end = self.first[bucket], self.first[bucket + 1]
        at = np.flatnonzero(place < end)
        place, end, wanted = place[at], end[at], h[at]
        found_at, found = [], []
        while len(at):
            ok = self.terms[place] == wanted
            found_at.append(at[ok])
            found.append(place[ok])
            on = np.flatnonzero(~ok & (place + 1 < end))
            at, place, end, wanted = at[on], place[on] + 1, end[on], wanted[on]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.concatenate(found_at)
        by = np.argsort(at, kind="stable")
        return at[by], np.concatenate(found)[by].astype(np.int64)


def postings(buf: np.ndarray, offsets: np.ndarray, places: Places):
    """(document, term, tf) sorted by document and term, and the documents' lengths."""
    docs, terms, counts, lengths = [], [], [], []
    t = max(1, len(places.terms))
    for i, j in B.slices(offsets, 4 * B.SLICE_BYTES):
        h, bounds = terms_of(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        lengths.append(np.diff(bounds))
        at, place = places(h)
        row = np.searchsorted(bounds, at, "right") - 1
        key, count = np.unique((row + i) * t + place, return_counts=True)
        docs.append(key // t)
        terms.append(key % t)
        counts.append(count)
    join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
    return join(docs, np.int64), join(terms, np.int64), join(counts, np.float64), join(lengths, np.float64)


#: Places of the number of documents and of words among those of terms.
_ROWS, _WORDS = -1, -2


def _frequencies(batches: Iterator[pa.RecordBatch], terms: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(at, n): the documents of each term, of all, and their words."""
    total, places = np.zeros(len(terms), np.int64), Places(terms)
    rows = words = 0
    for batch in batches:
        _, term, _, length = postings(*B.utf8(batch.column("text")), places)
        total += np.bincount(term, minlength=len(total))
        rows, words = rows + batch.num_rows, words + int(length.sum())
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array([_ROWS, _WORDS, *at]), pa.array([rows, words, *total[at]])], names=["at", "n"])


class Counts:
    """How many documents there are, their mean length, and the documents of each query term: one pass over all for many blocks of queries."""

    def __init__(self, docs: DataFrame, rows: DataFrame):
        self.terms, self.df, self.n, self.mean = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, 0.0
        fresh: list[np.ndarray] = []
        for _, terms in _blocks(rows):
            new = np.unique(np.concatenate(terms))
            fresh = [np.setdiff1d(np.unique(np.concatenate([*fresh, new])), self.terms, assume_unique=True)]
            if len(fresh[0]) >= COUNTED_TERMS:
                self._add(docs, fresh.pop())
        if fresh:
            self._add(docs, fresh.pop())

    def _add(self, docs: DataFrame, terms: np.ndarray) -> None:
        counted = (
            docs.select("text").mapInArrow(partial(_frequencies, terms=terms), "at long, n long")
            .groupBy("at").agg(F.sum("n").alias("n")).toArrow()
        )
        at, n = counted.column("at").to_numpy(), counted.column("n").to_numpy()
        self.n = int(n[at == _ROWS].sum())
        self.mean = int(n[at == _WORDS].sum()) / max(1, self.n)
        df = np.zeros(len(terms), np.int64)
        df[at[at >= 0]] = n[at >= 0]
        terms, df = np.concatenate([self.terms, terms]), np.concatenate([self.df, df])
        by = np.argsort(terms)
        self.terms, self.df = terms[by], df[by]

    def idf(self, terms: np.ndarray) -> np.ndarray:
        df = self.df[np.searchsorted(self.terms, terms)]
        return np.log(1 + (self.n - df + 0.5) / (df + 0.5))


class Cursors:
    """A cursor in the list of each of some terms; all stand at one block or behind it."""

    def __init__(self, segment: Segment, terms: np.ndarray):
        self.segment, self.terms = segment, terms
        self.at, self.end = segment.list_at[terms], segment.list_at[terms + 1]
        self.blocks = segment.entry[self.at] - terms * segment.n_blocks

    def to(self, block: int) -> None:
        """Moves cursors before a block to their first entry at or behind it, or to the end."""
        n = self.segment.n_blocks
        late = np.flatnonzero(self.blocks < block)
        # mostly the next entry will do; from the others on the list is searched
        self.blocks[late] = self.segment.after[self.at[late]]
        self.at[late] += 1
        late = late[self.blocks[late] < block]
        if len(late):
            at = np.searchsorted(self.segment.entry, self.terms[late] * n + block)
            self.at[late] = at
            inside = at < self.end[late]
            self.blocks[late] = n
            self.blocks[late[inside]] = self.segment.entry[at[inside]] - self.terms[late[inside]] * n

    def block(self, which: np.ndarray) -> np.ndarray:
        return self.blocks[which]


class Segment:
    """Inverted index of some documents for a block of queries.

    Documents are numbered anew so that blocks hold documents that share frequent terms, which
    keeps block maxima close to the impacts.  Impacts of frequent terms are also held as a dense
    table, so that documents of a block are scored for many queries by one matrix product.
    """

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, places: Places, idf: np.ndarray, mean: float):
        doc, term, tf, length = postings(buf, offsets, places)
        self.size, n_terms = len(length), len(places.terms)
        norm = K1 * (1 - B_LENGTH + B_LENGTH * length / max(mean, 1e-9))
        impact = idf[term] * tf * (K1 + 1) / (tf + norm[doc])
        self.term, self.impact = term, impact
        self.doc_at = np.searchsorted(doc, np.arange(self.size + 1))
        self.weight = np.zeros(n_terms)
        count = np.bincount(term, minlength=n_terms)
        often = np.flatnonzero(count > max(self.size * FREQUENT, 8))
        often = often[np.argsort(-count[often], kind="stable")][: DENSE_CELLS // max(1, self.size)]
        self.row = np.full(n_terms, -1)
        self.row[often] = np.arange(len(often))
        of_often = self.row[term] >= 0
        some = (self.row[term] < ALIKE) & of_often
        dense = np.zeros((self.size, min(len(often), ALIKE)), np.float32)
        dense[doc[some], self.row[term[some]]] = impact[some]
        parts = _alike(dense, np.arange(self.size))
        #: Documents by place, and where the blocks begin.
        self.docs = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.starts = np.cumsum([0, *map(len, parts)])
        place = np.empty(self.size, np.int64)
        place[self.docs] = np.arange(self.size)
        place = place[doc]
        self.dense = dense = np.zeros((self.size, len(often)), np.float32)
        dense[place[of_often], self.row[term[of_often]]] = impact[of_often]
        self.block_max = np.maximum.reduceat(self.dense, self.starts[:-1], axis=0) if parts else dense
        self.n_blocks = max(1, len(parts))
        #: Entries of the lists: term and block in one number, and the greatest impact.
        entry = term * self.n_blocks + np.searchsorted(self.starts, place, "right") - 1
        by = np.argsort(entry, kind="stable")
        entry, most = entry[by], impact[by]
        #: Postings of rare terms by place, and where those of each place begin.
        line = _ranges(self.doc_at[self.docs], np.diff(self.doc_at)[self.docs])
        line = line[~of_often[line]]
        self.line_term, self.line_impact = term[line], impact[line]
        self.line_at = np.searchsorted(place[line], np.arange(self.size + 1))
        first = np.flatnonzero(np.diff(entry, prepend=-1))
        self.entry = entry[first]
        self.entry_max = np.maximum.reduceat(most, first) if len(first) else np.zeros(0)
        self.list_at = np.searchsorted(self.entry, np.arange(n_terms + 1) * self.n_blocks)
        self.term_max = np.zeros(n_terms)
        np.maximum.at(self.term_max, self.entry // self.n_blocks, self.entry_max)
        #: The block of the next entry of the same list, or the number of blocks.
        block = self.entry % self.n_blocks
        last = np.append(self.entry[1:] // self.n_blocks != self.entry[:-1] // self.n_blocks, True)[: len(self.entry)]
        self.after = np.where(last, self.n_blocks, np.roll(block, -1))
        #: For every block, the next one at or behind it that holds each frequent term.
        self.next = np.full((self.n_blocks + 1, len(often)), self.n_blocks)
        for b in range(len(parts) - 1, -1, -1):
            self.next[b] = np.where(self.block_max[b] > 0, b, self.next[b + 1])
        self.often_max = self.term_max[often].astype(np.float32)
        #: What searches did: (query, block) pairs at a pivot, of these read and scored, and postings read.
        self.work = {"pivots": 0, "read": 0, "scored": 0, "postings": 0}

    def search(self, asked: list[np.ndarray], k: int, thresholds: np.ndarray, rank: np.ndarray) -> Iterator[list[tuple[float, int]]]:
        """Of every query, the (score, document) of the best k documents that reach its threshold."""
        n, n_blocks = len(asked), self.n_blocks
        held = [t[self.list_at[t + 1] > self.list_at[t]] for t in asked]
        term, query = np.concatenate(held), np.repeat(np.arange(n), [len(t) for t in held])
        rare = self.row[term] < 0
        frequent = np.zeros((n, self.dense.shape[1]), np.float32)
        frequent[query[~rare], self.row[term[~rare]]] = 1
        # rare terms of each query, and queries of each rare term
        query = query[rare]
        terms, of = np.unique(term[rare], return_inverse=True)
        first_of = np.searchsorted(query, np.arange(n + 1))
        by = np.argsort(of, kind="stable")
        asks, asked_n = query[by], np.bincount(of, minlength=len(terms))
        asks_at = np.cumsum(asked_n) - asked_n
        most, cursors = self.term_max[terms], Cursors(self, terms)
        rare_scores = self._rare_scores(terms, asks, asks_at, asked_n, n)
        # of every query and block, the sum of the maxima of the frequent terms that are in the block: of the whole lists, and of the block
        often_most = frequent @ ((self.block_max > 0) * self.often_max).T
        often_block = frequent @ self.block_max.T
        # sums of 32-bit floats are off by less than this
        least = np.maximum(thresholds, 1e-6) * (1 - SLACK)
        top = np.zeros((n, k))
        found_q, found_at, found_score = [], [], []
        pivot, moved, b = np.zeros(n, np.int64), np.arange(n), -1

        def rare_at(block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """The cursors at a block, how many queries each has, and these."""
            cursors.to(block)
            here = np.flatnonzero(cursors.blocks == block)
            return here, asked_n[here], asks[_ranges(asks_at[here], asked_n[here])]

        while b + 1 < n_blocks:
            # the next pivots of the queries that stood at block b: the next block, if its terms' maxima reach the threshold
            here, size, q = rare_at(b + 1)
            sums = (np.bincount(q, np.repeat(most[here], size), minlength=n) + often_most[:, b + 1])[moved]
            pivot[moved] = b + 1
            far = moved[sums < least[moved]]
            if len(far):
                pivot[far] = self._pivots(b + 1, frequent[far], least[far], far, first_of, of, most, cursors)
            if pivot.min() > b + 1:
                here, size, q = rare_at(int(pivot.min()))
            b = int(pivot.min())
            if b >= n_blocks:
                break
            moved = np.flatnonzero(pivot == b)
            self.work["pivots"] += len(moved)
            bound = (np.bincount(q, np.repeat(self.entry_max[cursors.at[here]], size), minlength=n) + often_block[:, b])[moved]
            which = moved[bound >= least[moved]]
            if not len(which):
                continue
            self.work["read"] += len(which)
            start, end = self.starts[b], self.starts[b + 1]
            score = rare_scores(start, end)[:, which]
            tight = score.max(0) + often_block[which, b] >= least[which]
            which, score = which[tight], score[:, tight]
            self.work["scored"] += len(which)
            score += self.dense[start:end] @ frequent[which].T
            hit = score >= least[which]
            some = hit.any(0)
            if some.any():
                which, score, hit = which[some], score[:, some].T, hit[:, some].T
                i, d = np.nonzero(hit)
                found_q.append(which[i])
                found_at.append(start + d)
                found_score.append(score[i, d])
                both = np.concatenate([top[which], score], axis=1)
                top[which] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
                least[which] = np.maximum(least[which], top[which].min(1) * (1 - SLACK))
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        q, at, score = join(found_q, np.int64), join(found_at, np.int64), join(found_score, float)
        good = score >= least[q]
        q, at = q[good], at[good]
        by = np.argsort(q, kind="stable")
        bounds = np.searchsorted(q[by], np.arange(n + 1))
        for i, terms in enumerate(asked):
            docs = self.docs[at[by[bounds[i] : bounds[i + 1]]]]
            yield self._best(docs, terms, k, rank) if len(docs) else []

    def _rare_scores(self, terms: np.ndarray, asks: np.ndarray, asks_at: np.ndarray, asked_n: np.ndarray, n: int) -> Callable[[int, int], np.ndarray]:
        """A function of a range of places: the sums of rare terms of each of their documents for each of n queries.

        Documents are taken a few at a time, each posting once for all queries that ask for its term; a few
        documents' sums stay in the processor's cache.
        """
        local = np.full(len(self.row), -1)
        local[terms] = np.arange(len(terms))
        mine = local[self.line_term]
        kept = np.flatnonzero(mine >= 0)
        mine, impact, at = mine[kept], self.line_impact[kept], np.searchsorted(kept, self.line_at)
        size = asked_n[mine]
        ends = np.concatenate([[0], np.cumsum(size)])
        shift = asks_at[mine] - ends[:-1]
        work = ends[at]

        ramp = np.arange(2 * STEP)

        def scores(start: int, end: int) -> np.ndarray:
            out = np.empty((end - start, n))
            self.work["postings"] += int(work[end] - work[start])
            done = start
            while done < end:
                # documents with STEP sums together, or one
                stop = min(max(int(np.searchsorted(work, work[done] + STEP, "right")) - 1, done + 1), end)
                some, count = slice(at[done], at[stop]), int(work[stop] - work[done])
                q = np.repeat(shift[some] + work[done], size[some])
                q += ramp[:count] if count <= len(ramp) else np.arange(count)
                q = asks.take(q, mode="clip")
                for d in range(done + 1, stop):
                    q[work[d] - work[done] : work[d + 1] - work[done]] += (d - done) * n
                sums = np.bincount(q, np.repeat(impact[some], size[some]), minlength=(stop - done) * n)
                out[done - start : stop - start] = sums.reshape(-1, n)
                done = stop
            return out

        return scores

    def _pivots(
        self, block: int, frequent: np.ndarray, least: np.ndarray, queries: np.ndarray,
        first_of: np.ndarray, of: np.ndarray, most: np.ndarray, cursors: Cursors,
    ) -> np.ndarray:
        """Of some queries, the first block at or behind the given one up to which the maxima of the terms met reach the threshold."""
        ahead = self.n_blocks + 1 - block
        n = first_of[queries + 1] - first_of[queries]
        rare = of[_ranges(first_of[queries], n)]
        at = np.repeat(np.arange(len(queries)) * ahead, n) + cursors.blocks[rare] - block
        sums = np.bincount(at, most[rare], minlength=len(queries) * ahead).reshape(-1, ahead).astype(float)
        often = np.zeros((frequent.shape[1], ahead), np.float32)
        often[np.arange(len(often)), self.next[block] - block] = self.often_max
        sums += frequent @ often
        # behind the last block there is nothing to reach
        reached = np.cumsum(sums[:, :-1], axis=1) >= least[:, None]
        return block + np.where(reached.any(1), reached.argmax(1), ahead - 1)

    def _best(self, docs: np.ndarray, terms: np.ndarray, k: int, rank: np.ndarray) -> list[tuple[float, int]]:
        """The best k of some documents by their exact scores, equal ones by rank."""
        n = self.doc_at[docs + 1] - self.doc_at[docs]
        at = _ranges(self.doc_at[docs], n)
        self.weight[terms] = 1
        # summed in the order of the terms, so equal documents have equal scores
        exact = np.bincount(np.repeat(np.arange(len(docs)), n), self.impact[at] * self.weight[self.term[at]], minlength=len(docs))
        self.weight[terms] = 0
        exact = np.round(exact, 9)
        order = np.lexsort((rank[docs], -exact))[:k]
        return [(float(exact[j]), int(docs[j])) for j in order if exact[j] > 0]


def _alike(dense: np.ndarray, docs: np.ndarray) -> list[np.ndarray]:
    """Blocks of documents that share frequent terms, by halving along the direction of most variance."""
    if not len(docs):
        return []
    if len(docs) <= BLOCK or not dense.shape[1]:
        return [docs[i : i + BLOCK] for i in range(0, len(docs), BLOCK)]
    x = dense[docs]
    x -= x.mean(0)
    v = np.linspace(1, 2, x.shape[1], dtype=np.float32)
    for _ in range(4):
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v) + np.float32(1e-9)
    half = len(docs) // 2
    order = np.argsort(x @ v, kind="stable")
    return _alike(dense, docs[order[:half]]) + _alike(dense, docs[order[half:]])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)


def _order(hit: tuple) -> tuple:
    return -hit[0], hit[1] is None, hit[1]


def _search(
    batches: Iterator[pa.RecordBatch], queries: Queries, idf: np.ndarray, mean: float, floors: np.ndarray, k: int
) -> Iterator[pa.RecordBatch]:
    """(q, found, score): the best k documents of the shard for every query, if they reach its floor."""
    places = Places(queries.terms)
    best: dict[int, list[tuple]] = {}
    threshold, kind = floors.copy(), None
    for batch in batches:
        buf, offsets = B.utf8(batch.column("text"))
        kind = batch.column("key").type
        for i, j in B.slices(offsets, SEGMENT_BYTES):
            keys = batch.column("key").slice(i, j - i)
            rank = pc.rank(keys, sort_keys="ascending", null_placement="at_end", tiebreaker="first").to_numpy()
            segment = Segment(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], places, idf, mean)
            for at in range(0, len(queries), TOGETHER):
                some = range(at, min(at + TOGETHER, len(queries)))
                found = segment.search([queries.of(q) for q in some], k, threshold[some.start : some.stop], rank)
                for q, hits in zip(some, found, strict=True):
                    if hits:
                        top = sorted([*best.get(q, ()), *((s, keys[d].as_py()) for s, d in hits)], key=_order)[:k]
                        best[q] = top
                        if len(top) == k:
                            threshold[q] = max(threshold[q], top[-1][0])
    if best:
        rows = [(q, *hit) for q, top in best.items() for hit in top]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[2] for r in rows], kind), pa.array([r[1] for r in rows], pa.float64())],
            names=["q", "found", "score"],
        )


def _blocks(rows: DataFrame) -> Iterator[tuple[list, list[np.ndarray]]]:
    keys, terms, held = [], [], 0
    for r in rows.toLocalIterator():
        keys.append(r["key"])
        terms.append(np.frombuffer(r["terms"], np.uint64))
        held += len(terms[-1])
        if held >= QUERY_POSTINGS:
            yield keys, terms
            keys, terms, held = [], [], 0
    if keys:
        yield keys, terms


def _shares(n: int) -> list[float]:
    """Shares of the ladder's samples, least first."""
    shares = []
    share = 1 / SAMPLE_STEP
    while n * share > SAMPLE_LEAST / SAMPLE_STEP:
        shares.append(share)
        share /= SAMPLE_STEP
    return shares[::-1]


def search(
    df: DataFrame, queries: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = K
) -> DataFrame:
    """(query, rank, found, score): the k best rows of df for every row of queries."""
    spark = df.sparkSession
    C.ship(spark)
    pick = lambda t: t.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    docs, asked = pick(df), pick(queries)
    kind = docs.schema["key"].dataType.simpleString()
    rows = C.cut(asked.mapInArrow(_query_rows, f"key {kind}, terms binary"))
    counts = Counts(docs, rows)
    schema = f"q int, found {kind}, score double"
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("found").asc_nulls_last())
    parts = []
    for keys, terms in _blocks(rows):
        block = Queries(terms)
        run = partial(_search, queries=block, idf=counts.idf(block.terms), mean=counts.mean, k=k)
        best = lambda d, floors: d.mapInArrow(partial(run, floors=floors), schema).withColumn(
            "rank", F.row_number().over(order)
        )
        floors = np.zeros(len(keys))
        for share in _shares(counts.n):
            sample = docs.where(C.unit_hash(F.col("key"), F.col("text"), F.lit("search")) < share)
            # a sample of few rows is one shard
            ranked = best(sample.coalesce(max(1, int(counts.n * share / SAMPLE_LEAST))), floors)
            for r in ranked.where(F.col("rank") == k).select("q", "score").toLocalIterator():
                floors[r["q"]] = max(floors[r["q"]], r["score"])
        named = spark.createDataFrame([(i, x) for i, x in enumerate(keys)], f"q int, query {kind}")
        top = C.cut(best(docs, floors).where(F.col("rank") <= k))
        parts.append(top.join(F.broadcast(named), "q").select("query", "rank", "found", "score"))
    if not parts:
        return spark.createDataFrame([], f"query {kind}, rank int, found {kind}, score double")
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    return found


def asked(key: Column) -> Column:
    """The stated query set: every row whose id is divisible by 50."""
    return key % 50 == 0


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 50."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = search(docs, docs.where(asked(F.col("doc_id"))))
    return found.select(
        F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("found").alias("doc_id"), F.round("score", 6).alias("score")
    )


OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM documents),
p AS (SELECT doc_id, term, CAST(count(*) AS DOUBLE) AS tf FROM w GROUP BY ALL),
l AS (SELECT doc_id, sum(tf) AS length FROM p GROUP BY 1),
g AS (SELECT count(*) AS n, (SELECT sum(length) FROM l) / count(*) AS mean FROM documents),
f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
i AS (
  SELECT p.doc_id, p.term, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * length / mean)) AS impact
  FROM p JOIN l USING (doc_id) JOIN f USING (term), g),
s AS (
  SELECT q.doc_id AS query_id, i.doc_id, round(sum(impact ORDER BY impact), 9) AS score
  FROM p q JOIN i USING (term) WHERE q.doc_id % 50 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10
"""

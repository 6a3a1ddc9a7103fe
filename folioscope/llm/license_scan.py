"""License scan: winnowed fingerprints pick candidates, local alignment reports coverage and spans.

Words are runs of ASCII letters and digits and of non-ASCII characters, in lower
case. A template's fingerprints are the least hashes of K-word shingles in each
window of W. The templates, a list in the code or the driver, are written to a file of the shared folder, and
each worker holds their inverted index. Every document is
fingerprinted alike, so a run of K + W - 1 words shared with a template gives a
common fingerprint; a template with fewer shingles than a window keeps its least one.

All words that an alignment through a template's hits can reach are aligned with it by
local alignment, so parts of a copy that stand apart are joined if the words between
them cost less than the lesser part gives; coverage is the share of the template's words
matched. Of overlapping spans the one with most matched words stays, then the best
covered; what lies outside the spans is aligned again until no match of enough coverage
is left, so copies that follow each other each give a row.

Defined results: null or wordless texts match nothing; documents without a match
give no row; repeated rows each give theirs; an empty table or no templates give an
empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folioscope.llm import words
from folioscope.llm.license_texts import TEMPLATES
from folioscope.llm.shared import file_system, new_folder, project, publish, slices, small_batches, tidy

K, W, COVERAGE = 3, 3, 0.8
MATCH, OTHER, GAP = 2, -1, -1
#: Words whose ends are aligned at a time; an alignment of positive score has less than 3 words to each of its template's.
BLOCK, REACH = 1 << 13, 3
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class Match(NamedTuple):
    template: int
    matched: int
    coverage: float
    first: int
    last: int


def winnow(hashes: np.ndarray, w: int = W) -> np.ndarray:
    """Places of the least hash (the last of equal ones) of each window of ``w``; of fewer hashes, the least one's."""
    n = len(hashes)
    if n <= w:
        return np.flatnonzero(hashes == hashes.min())[-1:] if n else np.zeros(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(hashes, w)[:, ::-1]
    return np.unique(np.arange(n - w + 1) + w - 1 - least.argmin(1))


class Index:
    """Fingerprints of templates: hash to (template, place)."""

    def __init__(self, templates: list[str]) -> None:
        self.words = [self.terms(t) for t in templates]
        self.places: dict[int, list[tuple[int, int]]] = {}
        for t, own in enumerate(self.words):
            h = words.hashes(pa.array(own, pa.large_string()))
            grams = words.window_hashes(h, K)
            for i in winnow(grams).tolist():
                self.places.setdefault(int(grams[i]), []).append((t, i))
        self.hashes = np.array(sorted(self.places), np.uint64)
        self.ids = {w: k for k, w in enumerate(dict.fromkeys(w for own in self.words for w in own))}
        self.codes = [np.array([self.ids[w] for w in own], np.int64) for own in self.words]
        self.rows = [self._rows(c) for c in self.codes]  # each word's place among the template's distinct ones; that place by id, last -1 for any other word

    @staticmethod
    def terms(text: str) -> list[str]:
        _, codes, vocabulary = words.split(pa.array([text], pa.large_string()), words.ALNUM)
        own = vocabulary.to_pylist()
        return [own[c] for c in codes.tolist()]

    def _rows(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distinct, rows = np.unique(codes, return_inverse=True)
        local = np.full(len(self.ids) + 1, -1)
        local[distinct] = np.arange(len(distinct))
        return rows, local

    def candidates(self, hits: list[tuple[int, int]], n: int) -> Iterator[tuple[int, int, int]]:
        """(template, bounds of the words that an alignment through one of its hits can reach) of each group of hits (place in the document of ``n`` words, hash)."""
        reached: dict[int, list[tuple[int, int]]] = {}
        for place, h in hits:
            for t, i in self.places[h]:
                reached.setdefault(t, []).append((max(0, place - REACH * i), min(n, place + REACH * (len(self.codes[t]) - i))))
        for t, own in reached.items():
            own.sort()
            low, high = own[0]
            for a, b in own[1:]:
                if a > high:
                    yield t, low, high
                    low = a
                high = max(a, b, high)
            yield t, low, high

    def ends(self, t: int, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score, matched words and first word of the best local alignment of a template that ends at each word; of equal scores that of most matched words, then the shortest."""
        n, size = len(text), len(self.codes[t])
        one = 1 << n.bit_length()  # a state is score, matched words and first word in one number, the greater the better
        unit = one << size.bit_length()
        if (2 * size + n) * unit >> 62:
            raise ValueError("this template is too long to align")
        rows, local = self.rows[t]
        place = np.argsort(local[text], kind="stable")  # places of each word of the template in the text
        cuts = np.searchsorted(local[text][place], np.arange(int(rows.max()) + 2))
        gain = (MATCH - OTHER) * unit + one
        empty = np.arange(n + 1)
        ramp = empty * -GAP * unit
        state, best = empty.copy(), np.zeros(n, np.int64)
        for r in rows.tolist():
            up = state + GAP * unit
            step = state[:-1] + OTHER * unit
            step[place[cuts[r] : cuts[r + 1]]] += gain
            np.maximum(up[1:], step, out=up[1:])
            up += ramp
            np.maximum.accumulate(up, out=up)
            up -= ramp
            state = np.where(up < unit, empty, up)
            np.maximum(best, state[1:], out=best)
        return best // unit, best % unit // one, best % one

    def align(self, t: int, low: int, high: int, text: np.ndarray, coverage: float) -> list[Match]:
        """Local alignments of a template within [low, high) that cover enough of it, best first, each apart from those before."""
        size, found = len(self.codes[t]), []
        counts = np.bincount(self.rows[t][1][text[low:high]] + 1, minlength=int(self.rows[t][0].max()) + 2)[1:]
        if np.minimum(counts, np.bincount(self.rows[t][0])).sum() / size < coverage:
            return []
        for a in range(low, high, BLOCK):
            start = max(low, a - REACH * size)
            score, matched, first = (x[a - start :] for x in self.ends(t, text[start : min(high, a + BLOCK)]))
            enough = np.flatnonzero((matched / size >= coverage) & (matched > 0))
            found += zip((-score[enough]).tolist(), (-matched[enough]).tolist(), (enough + a).tolist(), (first[enough] + start).tolist(), strict=True)
        free, out = np.ones(high - low, bool), []
        for _, matched, last, first in sorted(found):
            own = free[first - low : last - low + 1]
            if own.all():
                own[:] = False
                out.append(Match(t, -matched, -matched / size, first, last))
        return out

    def matches(self, text: list[str], hits: list[tuple[int, int]], coverage: float) -> list[Match]:
        codes = np.array([self.ids.get(w, -1) for w in text], np.int64)
        free, out = np.ones(len(codes), bool), []
        parts = list(self.candidates(hits, len(codes)))
        while parts:
            aligned = [(part, found) for part in parts if (found := self.align(*part, codes, coverage))]
            for m in sorted({m for _, found in aligned for m in found}, key=lambda m: (-m.matched, -m.coverage, m.first, m.template)):
                own = free[m.first : m.last + 1]
                if own.all():
                    own[:] = False
                    out.append(m)
            parts = [(t, low + a, low + b) for (t, low, high), _ in aligned for a, b in _runs(free[low:high])]
        return sorted(out, key=lambda m: m.first)


def _runs(free: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of true."""
    turns = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
    return list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))


@functools.lru_cache(1)
def opened(path: str) -> tuple[list[str], Index]:
    """Names and index of the templates in a file; a worker keeps them for its next tasks."""
    fs, own = file_system(path)
    with fs.open_input_stream(own) as source:
        templates = json.loads(zlib.decompress(source.read()))
    return list(templates), Index(list(templates.values()))


def scan(documents: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, license, coverage, matched_words, start_word, end_word, start_char and end_char (ends are exclusive) of each match."""
    templates = TEMPLATES if templates is None else templates
    spark = documents.sparkSession
    small_batches(spark)
    folder, data = new_folder(spark, "licenses"), zlib.compress(json.dumps(templates).encode())
    publish(folder, "templates", lambda sink: sink.write(data))
    path = f"{folder}/templates"
    documents = project(documents, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, index = opened(path)
        for whole in batches:
            for batch in slices(whole, "text"):
                yield _matches(batch, index, names, coverage)

    kind = dict(documents.dtypes)["doc_id"]
    return documents.mapInArrow(tidy(run), f"doc_id {kind}, license string, coverage double, matched_words long, start_word long, end_word long, start_char long, end_char long")


def _matches(batch: pa.RecordBatch, index: Index, names: list[str], coverage: float) -> pa.RecordBatch:
    ends, codes, vocabulary = words.split(batch.column("text"), words.ALNUM)
    grams = words.window_hashes(words.hashes(vocabulary)[codes], K) if len(codes) else np.zeros(0, np.uint64)
    known = np.flatnonzero(np.isin(grams, index.hashes))
    rows, found = [], []
    for i in np.unique(np.searchsorted(ends, known, "right") - 1).tolist() if len(known) else []:
        a, b = int(ends[i]), int(ends[i + 1])
        own = grams[a : max(a, b - K + 1)]
        kept = winnow(own)
        hits = [(p, int(own[p])) for p in kept.tolist() if int(own[p]) in index.places]
        if not hits:
            continue
        terms = vocabulary.take(pa.array(codes[a:b])).to_pylist()
        matches = index.matches(terms, hits, coverage)
        if matches:
            spans = [m.span() for m in WORD.finditer(batch.column("text")[i].as_py())]
            for m in matches:
                rows.append(i)
                found.append((names[m.template], m.coverage, m.matched, m.first, m.last + 1, spans[m.first][0], spans[m.last][1]))
    columns = list(zip(*found, strict=True)) or [()] * 7
    kinds = [pa.string(), pa.float64(), *[pa.int64()] * 5]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(pa.array(rows, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
        names=["doc_id", "license", "coverage", "matched_words", "start_word", "end_word", "start_char", "end_char"],
    )

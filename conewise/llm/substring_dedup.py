r"""Substring dedup with suffix automata of reference shards.

A word goes if a window of ``size`` words that covers it also starts in a document
with a smaller id; windows are judged on the input.

Screen.  A window's anchor is the smallest hash of the runs of ``ANCHOR`` words
in it.  Equal windows have equal anchors, so a window whose anchor stands in one
document only cannot be repeated.  Neighbouring windows with one anchor make a
segment.  Passages, the segments one after another whose anchors stand in
several documents, go on; the rest of the corpus does not.

Reference shards.  The distinct segments of the passages, each with the
smallest id of its documents, are the reference.  They are dealt to shards of
about ``SHARD_WORDS`` words by anchor, so all that can match a segment is in one
shard.  A task builds the suffix automaton of its shard over whole words; every
state carries the smallest id of the documents in which its strings end.

Streams.  Segments stream past the automaton of their own shard only, each
distinct text once: an automaton has a proven size bound, but there are as many
shards as the corpus asks for, and sending each to every task would cost shards
times documents.  At each word the matching statistic (state and length of the
longest match) gives the smallest id of a document with the window that ends
there.  Occurrences get the answers of their segment back through a join; the
fewer than ``1 / hot_keys.SHARE`` segments with most occurrences are broadcast.
A document's windows with a smaller id are merged and removed.

An anchor with more than ``HEAVY`` distinct segments (a passage in ever new
surroundings) is cut into single windows, which are grouped by text first; only
those found in several documents are left, dealt by their own hash.

Defined cases: a null text has no words; null ids come after all others and do
not count as smaller than each other; rows with the same id are one document as
to what they repeat (neither loses words to the other); equal rows get the same
result; a text with fewer words than a window, and no rows, lose nothing; texts
and words of any length are read whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conewise.llm import hashing, tokens
from conewise.llm.common import TEXT_ROWS, parts_for, plain_text, read_table, ship, written
from conewise.operators.hot_keys import SHARE, join_hot

#: Words of a window.
SIZE = 13
#: Words of the runs of which a window's smallest is its anchor.
ANCHOR = 4
#: Windows of a segment at most.
MOST_WINDOWS = 16
#: Words that a shard's segments hold on average, and distinct segments of an anchor from which they are cut.
SHARD_WORDS = 40_000
HEAVY = 2_000
#: Bytes whose words are hashed at a time, so that the arrays stay in a core's cache.
SLICE = 1 << 17

_NONE = (1 << 63) - 1  # an id after all others
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_STEP = np.uint64(0x9FB21C651E98DF25)


# --- words and segments ---


def _parts(raw: bytes) -> list[bytes]:
    """A long text in parts that end between words; a part longer than the tables of powers is one word."""
    most, out, start = hashing.MOST_BYTES // 2, [], 0
    while len(raw) - start > most:
        between = np.flatnonzero(_SPACE[np.frombuffer(raw, np.uint8, most, start)])
        if len(between):
            end = start + int(between[-1])
        else:
            end = start + most
            while end < len(raw) and raw[end] not in b" \t\n\v\f\r":
                end += 1
        out.append(raw[start:end])
        start = end + 1
    return [*out, raw[start:]]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts of any length, and the number of words of each."""
    parts = [(i, p) for i, t in enumerate(texts) for p in (_parts(t) if len(t) > hashing.MOST_BYTES // 2 else (t,))]
    hashes, counts = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
    for a, b in tokens.slices([len(p) + 1 for _, p in parts], SLICE):
        few = parts[a:b]
        for some in (few,) if sum(len(p) + 1 for _, p in few) < hashing.MOST_BYTES else ([p] for p in few):
            if len(some) == 1 and len(some[0][1]) >= hashing.MOST_BYTES // 2:
                word = some[0][1].strip(b" \t\n\v\f\r")
                if len(word.split()) == 1:
                    hashes.append(np.array([hashing.long_span(word)]))
                    counts[some[0][0]] += 1
                    continue
            buffer = np.frombuffer(b" ".join(p for _, p in some) + b" ", np.uint8)
            edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[buffer])).astype(np.int8)))
            starts, ends = edge[0::2], edge[1::2]
            hashes.append(hashing.spans(buffer, starts, ends))
            for i in np.flatnonzero(ends - starts >= hashing.MOST_BYTES // 2).tolist():  # as where it stands alone
                hashes[-1][i] = hashing.long_span(buffer[starts[i] : ends[i]].tobytes())
            bounds = np.concatenate(([0], np.cumsum([len(p) + 1 for _, p in some])))
            np.add.at(counts, [i for i, _ in some], np.diff(np.searchsorted(starts, bounds)))
    return np.concatenate(hashes), counts


def _run_hashes(runs: np.ndarray, first: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hash of the words from ``first`` on, from the hashes of the runs of ANCHOR words that cover them."""
    out = runs[first + words - ANCHOR] + words.astype(np.uint64)
    for j in range(0, int(words.max(initial=0)) - ANCHOR, ANCHOR):
        more = np.flatnonzero(j + ANCHOR < words)
        out[more] = hashing.mix(out[more] * _STEP + runs[first[more] + j])
    return out


def segments(texts: list[bytes], size: int = SIZE, hashed: bool = True) -> dict[str, np.ndarray]:
    """The segments of some texts: text, start (its first word), n (windows), anchor, and, if ``hashed``, the hash of its words."""
    h, counts = word_hashes(texts)
    if len(h) < size:
        none = np.zeros(0, np.int64)
        return {"text": none, "start": none, "n": none, "anchor": none, "hash": none}
    runs = np.zeros(len(h) - ANCHOR + 1, np.uint64)
    for j in range(ANCHOR):
        runs = hashing.mix(runs * _STEP + h[j : len(runs) + j])
    low, width, whole = runs, 1, size - ANCHOR + 1
    while width < whole:  # the smallest of 2, 4, 8 ... runs, up to a whole window
        step = min(width, whole - width)
        low = np.minimum(low[: len(low) - step], low[step:])
        width += step
    of = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(of[: len(low)] == of[size - 1 :])
    low = low[at]
    new = np.concatenate(([True], (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1) | (of[at[1:]] != of[at[:-1]])))[: len(at)]
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(at)))
    pieces = -(-length // MOST_WINDOWS)  # long runs (periodic text) are cut
    within = (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * MOST_WINDOWS
    length = np.minimum(np.repeat(length, pieces) - within, MOST_WINDOWS)
    first = np.repeat(first, pieces) + within
    start = at[first]
    return {"text": of[start], "start": start - (np.cumsum(counts) - counts)[of[start]], "n": length,
            "anchor": low[first].view(np.int64),
            "hash": _run_hashes(runs, start, length + size - 1).view(np.int64) if hashed else np.zeros(len(first), np.int64)}


def _raw(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


# --- suffix automata ---


class SuffixAutomaton:
    """Of several sequences of words; each state has the smallest document in which its strings end."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [_NONE]

    def _state(self, length: int, link: int, then: dict[str, int]) -> int:
        self.next.append(then)
        self.link.append(link)
        self.length.append(length)
        self.first.append(_NONE)
        return len(self.link) - 1

    def _split(self, before: int, word: str, state: int) -> int:
        """The state of the strings of ``state`` that are one word longer than those of ``before``."""
        if self.length[state] == self.length[before] + 1:
            return state
        twin = self._state(self.length[before] + 1, self.link[state], dict(self.next[state]))
        self.link[state] = twin
        while before >= 0 and self.next[before].get(word) == state:
            self.next[before][word] = twin
            before = self.link[before]
        return twin

    def add(self, words: Iterable[str], document: int) -> None:
        then, link, length, first = self.next, self.link, self.length, self.first
        last = 0
        for word in words:
            state = then[last].get(word)
            if state is not None:
                last = state if length[state] == length[last] + 1 else self._split(last, word, state)
                if document < first[last]:
                    first[last] = document
                continue
            new, before = len(link), last
            then.append({})
            link.append(0)
            length.append(length[last] + 1)
            first.append(document)
            while before >= 0 and word not in then[before]:
                then[before][word] = new
                before = link[before]
            if before >= 0:
                link[new] = self._split(before, word, then[before][word])
            last = new

    def finish(self) -> None:
        """Documents of longer strings are those of their suffixes too."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if self.first[state] < self.first[up]:
                self.first[up] = self.first[state]

    def matches(self, words: Iterable[str]) -> Iterator[tuple[int, int]]:
        """Matching statistics: after each word, the state and the length of the longest match that ends there."""
        then, link, lengths = self.next, self.link, self.length
        state = length = 0
        for word in words:
            step = then[state].get(word)
            while step is None and state:
                state = link[state]
                length = lengths[state]
                step = then[state].get(word)
            if step is not None:
                state, length = step, length + 1
            yield state, length

    def first_documents(self, words: list[str], size: int) -> list[int]:
        """Smallest document with each window of ``size`` words, _NONE if there is none."""
        link, lengths, out = self.link, self.length, []
        for state, length in self.matches(words):
            if length < size:
                out.append(_NONE)
                continue
            up = link[state]
            while lengths[up] >= size:
                state, up = up, link[up]
            out.append(self.first[state])
        return out[size - 1 :]


def _answers(reference: DataFrame, size: int) -> DataFrame:
    """(anchor, hash, firsts): the smallest document of each window of the reference's segments (anchor, hash, doc, text, shard)."""

    def run(table: pa.Table) -> pa.Table:
        automaton = SuffixAutomaton()
        texts = [t.split(" ") for t in table["text"].to_pylist()]
        for words, document in zip(texts, table["doc"].to_pylist(), strict=True):
            automaton.add(words, document)
        automaton.finish()
        return pa.table({"anchor": table["anchor"], "hash": table["hash"],
                         "firsts": pa.array([automaton.first_documents(w, size) for w in texts], pa.list_(pa.int64()))})

    return reference.groupBy("shard").applyInArrow(run, "anchor long, hash long, firsts array<long>")


def _sharded(reference: DataFrame, key: str, words: int) -> DataFrame:
    return reference.withColumn("shard", F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(parts_for(words, SHARD_WORDS))))


# --- Spark ---


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, doc (the id, nulls last), tie, key (screening only: a clash lets more through) and text."""
    rows = docs.select(F.col("doc_id").cast("long"), plain_text().alias("text"))
    return rows.select("doc_id", F.coalesce("doc_id", F.lit(_NONE)).alias("doc"), F.xxhash64("text").alias("tie"),
                       F.xxhash64("doc_id", "text").alias("key"), "text")


def _placed(rows: DataFrame, size: int, hashed: bool = True) -> DataFrame:
    """(anchor, hash, doc, tie, key, place): every segment of the texts; place is 256 * its first word + its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = segments(_raw(batch.column("text")), size, hashed)
            of = pa.array(found["text"])
            begin = batch.column("start").to_numpy()[found["text"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found["anchor"]), pa.array(found["hash"]), *[batch.column(c).take(of) for c in ("doc", "tie", "key")],
                 pa.array((found["start"] + begin) * 256 + found["n"])], ["anchor", "hash", "doc", "tie", "key", "place"])

    return rows.select("doc", "tie", "key", "start", "text").mapInArrow(
        run, "anchor long, hash long, doc long, tie long, key long, place long")


def passages(docs: DataFrame, size: int) -> DataFrame:
    """Written table (doc, tie, start, text, key): the runs of windows whose anchors stand in several documents; key numbers them."""
    placed = _placed(_keyed(docs).withColumn("start", F.lit(0).cast("long")), size, hashed=False)
    anchors = (placed.select("anchor", "doc").groupBy("anchor")
               .agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("n")).filter("low < high"))
    anchors = written(anchors.select("anchor", "n"), "shared-anchors")
    total = anchors.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = anchors.filter(F.col("n") > SHARE * total).select("anchor")  # fewer than 1 / SHARE
    shared = join_hot(placed.select("anchor", "key", "place"), anchors.select("anchor"), ["anchor"], hot)
    places = written(shared.groupBy("key").agg(F.collect_set("place").alias("places")), "shared-places").hint("merge")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tie = (batch.column(c).to_pylist() for c in ("doc", "tie"))
            out = {"doc": [], "tie": [], "start": [], "text": []}
            for i, (raw, places) in enumerate(zip(_raw(batch.column("text")), batch.column("places"), strict=True)):
                words = raw.split()
                starts, ends = _runs(np.asarray(places.values), size)
                for a, b in zip(starts.tolist(), np.minimum(ends, len(words)).tolist(), strict=True):
                    if b - a >= size:
                        out["doc"].append(doc[i])
                        out["tie"].append(tie[i])
                        out["start"].append(a)
                        out["text"].append(b" ".join(words[a:b]).decode())
            yield pa.RecordBatch.from_pydict({**{c: pa.array(out[c], pa.int64()) for c in ("doc", "tie", "start")},
                                              "text": pa.array(out["text"], pa.string())})

    joined = _keyed(docs).join(places, "key").select("doc", "tie", "text", "places")
    return written(joined.mapInArrow(run, "doc long, tie long, start long, text string")
                   .withColumn("key", F.monotonically_increasing_id()), "passages", TEXT_ROWS)


def _runs(places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end words of the runs that windows one after another make."""
    places = np.sort(places)
    start, n = places >> 8, places & 255
    upto = np.maximum.accumulate(start + n)
    new = np.concatenate(([True], start[1:] > upto[:-1]))
    at = np.flatnonzero(new)
    return start[at], upto[np.append(at[1:] - 1, len(start) - 1)] + size - 1


def distinct_segments(found: DataFrame, placed: DataFrame, size: int) -> DataFrame:
    """Written table (anchor, hash, doc, last, n, words, text): each segment with its first and last document and occurrences."""
    each = placed.groupBy("anchor", "hash").agg(
        F.min("doc").alias("doc"), F.max("doc").alias("last"), F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("at"))
    wanted = each.groupBy(F.col("at.key").alias("key")).agg(
        F.collect_list(F.struct(F.col("at.place").alias("place"), "anchor", "hash", "doc", "last", "n")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("wanted")
            flat = pc.list_flatten(lists)
            place = np.asarray(flat.field("place"))
            begin = np.repeat(batch.column("start").to_numpy(), np.asarray(pc.list_value_length(lists)))
            first, words = (place >> 8) - begin, (place & 255) + size - 1
            texts, at = [], 0
            for text, many in zip(batch.column("text").to_pylist(), np.asarray(pc.list_value_length(lists)).tolist(), strict=True):
                own = text.split(" ")
                texts += [" ".join(own[a : a + w]) for a, w in zip(first[at : at + many].tolist(), words[at : at + many].tolist(), strict=True)]
                at += many
            yield pa.RecordBatch.from_arrays(
                [*[flat.field(c) for c in ("anchor", "hash", "doc", "last", "n")], pa.array(words), pa.array(texts, pa.string())],
                ["anchor", "hash", "doc", "last", "n", "words", "text"])

    joined = found.join(written(wanted, "wanted").hint("merge"), "key").select("start", "text", "wanted")
    return written(joined.mapInArrow(run, "anchor long, hash long, doc long, last long, n long, words long, text string"), "segments", TEXT_ROWS)


def answered(reference: DataFrame, size: int, heavy: int) -> DataFrame:
    """(anchor, hash, at, firsts): the smallest document of the windows of each segment from its window ``at`` on."""
    crowded = written(reference.groupBy("anchor").agg(F.count("*").alias("many")).filter(F.col("many") > heavy).select("anchor"), "heavy-anchors")
    light, some = reference, not crowded.isEmpty()
    if some:
        light = reference.join(crowded, "anchor", "left_anti")
    words = reference.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    out = _answers(_sharded(light, "anchor", words).select("anchor", "hash", "doc", "text", "shard"), size).withColumn("at", F.lit(0).cast("long"))
    if some:
        own = F.split("text", " ")
        each = F.transform(F.sequence(F.lit(1), F.col("words") - size + 1),
                           lambda i: F.array_join(F.slice(own, i.cast("int"), size), " "))
        cut = reference.join(crowded, "anchor").select("anchor", "hash", "doc", "last", F.posexplode(each).alias("at", "window"))
        cut = written(cut.withColumns({"w1": F.xxhash64("window"), "w2": F.xxhash64(F.lit(1), "window")}), "windows")
        whole = cut.groupBy("w1", "w2").agg(F.min("doc").alias("doc"), F.max("last").alias("last"), F.count("*").alias("n"), F.min("window").alias("text"))
        whole = written(whole.filter("doc < last"), "repeated-windows")
        total, rows = whole.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        found = written(_answers(_sharded(whole.select(F.col("w1").alias("anchor"), F.col("w2").alias("hash"), "doc", "text"), "anchor", rows * size),
                                 size), "window-answers").select(F.col("anchor").alias("w1"), F.col("hash").alias("w2"), "firsts")
        hot = whole.filter(F.col("n") > SHARE * total).select("w1", "w2")  # fewer than 1 / SHARE
        met = join_hot(cut.select("anchor", "hash", "at", "w1", "w2"), found, ["w1", "w2"], hot)
        out = out.unionByName(met.select("anchor", "hash", F.col("at").cast("long"), "firsts"))
    return written(out, "answers")


def repeated_words(docs: DataFrame, size: int = SIZE, heavy: int = HEAVY) -> DataFrame:
    """(doc, tie, covered): windows of each document that start in one with a smaller id, as 65536 * first word + a mask of windows."""
    found = passages(docs, size)
    placed = _placed(found, size)
    reference = distinct_segments(found, placed, size)
    answers = answered(reference, size, heavy)
    total = reference.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = reference.filter(F.col("n") > SHARE * total).select("anchor", "hash")  # fewer than 1 / SHARE
    met = join_hot(placed.select("anchor", "hash", "doc", "tie", "place"), answers, ["anchor", "hash"], hot)
    bits = F.transform("firsts", lambda f, i: F.when(f < F.col("doc"), F.call_function("shiftleft", F.lit(1), i)).otherwise(0))
    mask = F.aggregate(bits, F.lit(0), lambda a, b: a + b)
    covered = met.select("doc", "tie", (F.shiftright("place", 8) + F.col("at")).alias("start"), mask.alias("mask")).filter("mask > 0")
    return covered.groupBy("doc", "tie").agg(F.collect_set(F.col("start") * 65536 + F.col("mask")).alias("covered"))


def _removed(covered: np.ndarray, words: int, size: int) -> np.ndarray:
    """Marks of the words that the covered windows hold."""
    step = np.zeros(words + 1, np.int64)
    for i in range(MOST_WINDOWS):
        start = (covered >> 16)[(covered >> i) & 1 == 1] + i
        np.add.at(step, start, 1)
        np.add.at(step, start + size, -1)
    return np.cumsum(step[:-1]) > 0


def substring_dedup(docs: DataFrame, size: int = SIZE, heavy: int = HEAVY) -> DataFrame:
    """One row per document: doc_id, its words without repeated ones, joined by one space (text), n_words, n_removed."""
    ship(docs.sparkSession)
    # the same join at every size: by sorting, whether or not the list would fit a broadcast
    covered = written(repeated_words(docs, size, heavy), "covered").hint("merge")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_words, n_removed = [], [], []
            for raw, places in zip(_raw(batch.column("text")), batch.column("covered"), strict=True):
                words = raw.split()
                n_words.append(len(words))
                if places.is_valid:
                    gone = _removed(np.asarray(places.values), len(words), size)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                n_removed.append(n_words[-1] - len(words))
                texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
                ["doc_id", "text", "n_words", "n_removed"])

    joined = _keyed(docs).join(covered, ["doc", "tie"], "left").select("doc_id", "text", "covered")
    return joined.mapInArrow(run, "doc_id long, text string, n_words long, n_removed long")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {_NONE}) AS doc,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
windows AS (SELECT r, doc, i, w[i:i + {SIZE - 1}] AS win FROM (SELECT r, doc, w, unnest(range(1, len(w) - {SIZE - 2})) AS i FROM d)),
again AS (SELECT r, i FROM (SELECT r, i, doc, min(doc) OVER (PARTITION BY win) AS low FROM windows) WHERE low < doc),
covered AS (SELECT DISTINCT r, unnest(range(i, i + {SIZE})) AS i FROM again),
each AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM each ANTI JOIN covered USING (r, i) GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (r)
"""

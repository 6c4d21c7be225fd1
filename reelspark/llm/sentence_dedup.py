"""Substring dedup by sliding sentence spans.

Every run of RUN consecutive sentences is hashed, whatever its sentences and however few
words they have, and so each longer run by the runs in it. Spans of the same words meet
in one shuffle over the corpus; the first of them, by document id and place, stays, and
sentences that any other span covers are removed.

So that no passage of PASSAGE words stays twice, however few sentences it is made of,
there are two further kinds of spans, both only where the runs don't reach: a sentence of
PASSAGE words or more is a span by itself; and of PASSAGE words in a row with less than
RUN whole sentences within, one run of GRAM words is (that of the least hash, so that
equal passages choose alike), of which just the words go. A sentence of less than GRAM
words that stands alone in two texts stays in both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import once, released, slices, text_of
from reelspark.llm.hashing import Spans, mixed

#: Sentences that are several.
RUN = 3
#: Words that don't stay twice in a row, and those of them that are compared where sentences are long: the fewer, the fewer rows.
PASSAGE, GRAM = 51, 48
#: Text in which repeats are found before anything is shuffled; of a span, each such part sends one place.
PART_BYTES = 8 << 20
#: Text that is hashed at a time.
BATCH_BYTES = 1 << 19
MARKS, FULL_MARKS = ".!?。！？", "。！？"
#: Scripts without spaces between words: Thai to Tibetan, Myanmar, Khmer, Chinese and Japanese.
UNSPACED = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x312F), (0x3190, 0x9FFF), (0xF900, 0xFAFF), (0xFF00, 0xFFEF), (0x20000, 0x3FFFF))


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each code point: whether it is white space, whether it is a word of its own, and its lower case."""
    alone = np.zeros(0x110000, bool)
    for low, high in UNSPACED:
        alone[low : high + 1] = True
    every = range(0x110000)
    lower = np.fromiter((ord(x) if len(x := chr(i).lower()) == 1 else i for i in every), np.uint32, len(every))
    return np.fromiter((chr(i).isspace() for i in every), bool, len(every)), alone, lower


class Layout:
    """Sentences and words of several texts, as places in their code points.

    A sentence ends behind marks with white space, behind a line's end and behind a
    fullwidth mark, and takes the white space behind it. Each code point of a script
    without spaces is a word. words, owner, sentence: of each word, where it starts, its
    text and its sentence; bounds: where sentences start; first_word: of each text.
    """

    def __init__(self, texts: list[str]):
        space, alone, lower = once("sentence tables", _tables)
        points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.firsts, self.lengths = np.cumsum(lengths + 1) - lengths - 1, lengths
        n = len(points)
        blank, at = space[points], np.arange(n)
        text_of_ = np.minimum(np.repeat(np.arange(len(texts)), lengths + 1)[:n], len(texts) - 1)
        mark, full = (np.isin(points, [ord(c) for c in marks]) for marks in (MARKS, FULL_MARKS))
        before = np.concatenate([[True], blank[:-1]])[:n]  # a blank stands before
        after_run = np.flatnonzero(~blank & before)
        said = np.maximum.accumulate(np.where(blank, -1, at)) if n else at  # the last code point that is no blank
        last = np.where(after_run > 0, said[after_run - 1], -1)
        first = self.firsts[text_of_[after_run]]
        lines = np.concatenate([[0], np.cumsum(points == 10)])
        ended = (lines[after_run] > lines[np.maximum(last + 1, first)]) | (last >= first) & mark[last]
        joined = np.flatnonzero(~blank[1:] & ~mark[1:] & full[:-1]) + 1
        self.bounds = np.unique(np.concatenate([self.firsts[lengths > 0], after_run[ended], joined]))
        self.n_sentences = np.bincount(text_of_[self.bounds], minlength=len(texts)) if n else np.zeros(len(texts), np.int64)

        own = alone[points]
        self.words = np.flatnonzero(~blank & (before | own | np.concatenate([[True], own[:-1]])[:n]))
        ends = np.append(self.words[1:], n)[: len(self.words)]
        stops = said[ends - 1] + 1  # without the blanks behind
        spelt = Spans(lower[points] + np.uint64(1), "bytes")
        self.hashes = mixed(spelt.of(self.words, stops) + (stops - self.words).astype(np.uint64))
        self.owner = text_of_[self.words]
        self.sentence = np.searchsorted(self.bounds, self.words, "right") - 1
        self.first_word = np.searchsorted(self.owner, np.arange(len(texts) + 1))

    def _runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First word and word behind, of each run of RUN sentences and of each sentence of PASSAGE words."""
        n = len(self.words)
        begin = np.flatnonzero(np.diff(self.sentence, prepend=-1))  # sentences without words are passed over
        end = np.append(begin[1:], n)[: len(begin)]
        first = np.arange(max(0, len(begin) - RUN + 1))
        first = first[self.owner[begin[first]] == self.owner[begin[first + RUN - 1]]]
        long = np.flatnonzero(end - begin >= PASSAGE)
        return begin[first], end[first + RUN - 1], begin[long], end[long]

    def _grams(self, hashes: np.ndarray) -> np.ndarray:
        """First words of the runs of GRAM words that passages with few sentences choose; hashes: of all such runs."""
        at = np.arange(max(0, len(self.words) - PASSAGE + 1))
        starts = np.concatenate([[0], np.cumsum(np.diff(self.sentence, prepend=-1) != 0)])
        inner = starts[at + PASSAGE] - starts[at + 1]  # sentences that begin within, but for the first word
        at = at[(self.owner[at] == self.owner[at + PASSAGE - 1]) & (inner <= RUN)]
        if not len(at):
            return at
        tried = np.stack([hashes[at + i] for i in range(PASSAGE - GRAM + 1)])
        return np.unique(at + tried.argmin(axis=0))

    def spans(self) -> tuple[np.ndarray, ...]:
        """(text, hash, hash, first word, words) of the spans; case and white space don't count."""
        spelt = [Spans(self.hashes, "words"), Spans(mixed(self.hashes + np.uint64(1)), "bytes")]
        run, run_end, long, long_end = self._runs()
        gram = self._grams(mixed(spelt[0].every(GRAM)))
        a, b = np.concatenate([run, long, gram]), np.concatenate([run_end, long_end, gram + GRAM])
        a, b = np.unique(np.stack([a, b]), axis=1)
        one, two = (mixed(x.of(a, b) + (b - a).astype(np.uint64)).view(np.int64) for x in spelt)
        owner = self.owner[a]
        return owner, two, one, a - self.first_word[owner], b - a

    def without(self, i: int, text: str, dropped: list[tuple[int, int]]) -> tuple[str, int]:
        """Text i without runs (first word, words) of its words, each with the white space behind, and how many sentences lose any."""
        a, b = self.first_word[i], self.first_word[i + 1]
        drop = np.zeros(b - a, bool)
        for first, n in dropped:
            drop[first : first + n] = True
        at = (self.words[a:b] - self.firsts[i]).tolist()
        at[:1] = [0] * len(at[:1])
        turns = np.flatnonzero(np.diff(drop.view(np.int8), prepend=np.int8(0), append=np.int8(0))).reshape(-1, 2).tolist()
        at.append(len(text))
        kept, done = [], 0
        for x, y in turns:
            kept.append(text[done : at[x]])
            done = at[y]
        return "".join([*kept, text[done:]]), len(np.unique(self.sentence[a:b][drop]))


def sentences(text: str) -> list[str]:
    """Sentences with the white space behind them; joined, they are the text."""
    at = Layout([text]).bounds.tolist()
    return [text[a:b] for a, b in zip(at, [*at[1:], len(text)])]


def _sent(row: np.ndarray, rank: np.ndarray, key: np.ndarray, high: np.ndarray, low: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the spans of a part: the first place of each, and the places behind it."""
    order = np.lexsort((key[row], first, rank[row], low, high))
    new = (np.diff(high[order], prepend=0) != 0) | (np.diff(low[order], prepend=0) != 0)
    new[:1] = True
    lead = order[new][np.cumsum(new) - 1]
    # rows of the same id and text are one document, and have one place
    same = (rank[row[order]] == rank[row[lead]]) & (key[row[order]] == key[row[lead]]) & (first[order] == first[lead])
    return order[new], order[~same]


def _merged(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop) of the runs that spans of a row make up together."""
    order = np.lexsort((start, row))
    row, start, stop = row[order], start[order], stop[order]
    shift = row * (int(stop.max(initial=0)) + 2)  # so that rows don't reach each other
    reach = np.maximum.accumulate(stop + shift) if len(row) else stop
    new = np.flatnonzero(np.concatenate([[True], (start + shift)[1:] > reach[:-1]])[: len(row)])
    last = np.append(new[1:], len(row))[: len(new)] - 1
    return row[new], start[new], reach[last] - shift[last]


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_id, _key, _at) of all places but the first of each span, out of (_id, _key, _low, _high, _at, _known) sorted by span, then by place.

    A span's rows stream by, however many they are; its first place is the row that comes
    first, if it isn't known to be a later one.
    """
    lead = None
    for batch in batches:
        if not batch.num_rows:
            continue
        low, high, at, key = (batch.column(i).to_numpy() for i in (2, 3, 4, 1))
        ids, known = batch.column(0), batch.column(5).to_numpy(zero_copy_only=False)
        new = (np.diff(low, prepend=low[0]) != 0) | (np.diff(high, prepend=high[0]) != 0)
        new[0] = lead is None or (low[0], high[0]) != lead[:2]
        first = np.flatnonzero(new)
        goes_on = first[:1].tolist() != [0]  # the batch begins with the span that the last one ended with
        told = [lead[2:]] if goes_on else []
        told += [*zip(ids.take(pa.array(first)).to_pylist(), at[first].tolist(), key[first].tolist(), known[first].tolist())]
        group = np.cumsum(new) - (0 if goes_on else 1)
        name = ids.dictionary_encode()  # equal ids have equal numbers
        numbers = {x: i for i, x in enumerate(name.dictionary.to_pylist())}
        number = name.indices.fill_null(-1).to_numpy()
        lead_number = np.array([-1 if x[0] is None else numbers.get(x[0], -2) for x in told])[group]
        lead_at, lead_key, lead_known = (np.array([x[i] for x in told])[group] for i in (1, 2, 3))
        out = np.flatnonzero(known | lead_known | (at != lead_at) | (key != lead_key) | (number != lead_number))
        lead = (low[-1], high[-1], *told[group[-1]])
        if len(out):
            yield pa.record_batch([ids.take(pa.array(out)), pa.array(key[out]), pa.array(at[out])], ["_id", "_key", "_at"])


def remove_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text, n_sentences, n_removed) of every row of df, without the sentences of non-first repeated spans.

    Of spans that are runs of words, only the words go; n_removed counts the sentences that lose anything.
    First is the span in the smallest id, then at the smallest place; a null id comes
    before all. Repeats within a document count. Rows of the same id and text are one
    document: each of them gives what one of them would. A null text has no sentences
    and stays null. Other columns are not read; an empty df gives no rows.

    Texts are hashed once. In each part of PART_BYTES, of the places of a span the first
    goes to its hash; of the others it's known that they aren't the first one, so they go
    to the shuffle under numbers of their own, neighbours merged. So a span that any
    share of all documents has is one row for each part.
    """
    kind = df.schema[id_col].dataType.simpleString()
    source = df.select(df[id_col].alias("_id"), df[text_col].cast("string").alias("_text"))
    # of a text, enough to tell rows of one id apart
    keyed = source.withColumn("_key", F.xxhash64(text_of("_text")))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 2, PART_BYTES):
            found, done = [], 0
            for some in slices(iter([rows]), 2, BATCH_BYTES):
                owner, *more = Layout(some.column(2).to_pylist()).spans()
                found.append((owner + done, *more))
                done += some.num_rows
            row, high, low, first, n = map(np.concatenate, zip(*found))
            if len(row):
                yield places(rows, row, high, low, first, n)

    def places(rows: pa.RecordBatch, row: np.ndarray, high: np.ndarray, low: np.ndarray, first: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        """(_id, _key, _low, _high, _at) of a part; _at: first word and number of words, negative for what is known to be later."""
        names, key = rows.column(0).to_pylist(), rows.column(1).to_numpy()
        rank = {x: i for i, x in enumerate(sorted(set(names), key=lambda x: (x is not None, x)))}
        kept, later = _sent(row, np.array([rank[x] for x in names]), key, high, low, first)
        kept = np.sort(kept)  # by document, so that neighbours are alike
        owner, a, b = _merged(row[later], first[later], first[later] + n[later])
        anywhere = mixed(mixed((owner << 32 | a).astype(np.uint64)) + key[owner].view(np.uint64)).view(np.int64)
        own = np.concatenate([row[kept], owner])
        at = np.concatenate([first[kept] << 32 | n[kept], -(a << 32 | b - a)])
        return pa.record_batch([rows.column(0).take(pa.array(own)), pa.array(key[own]), pa.array(np.concatenate([low[kept], anywhere])), pa.array(np.concatenate([high[kept], anywhere])), pa.array(at)], ["_id", "_key", "_low", "_high", "_at"])

    found = keyed.select("_id", "_key", text_of("_text").alias("_text")).mapInArrow(released(hashed), f"_id {kind}, _key long, _low long, _high long, _at long")
    dealt = found.repartition("_low").select("_id", "_key", "_low", "_high", F.abs("_at").alias("_at"), (F.col("_at") < 0).alias("_known"))
    later = dealt.sortWithinPartitions("_low", "_high", "_known", "_id", "_at", "_key").mapInArrow(released(_later), f"_id {kind}, _key long, _at long")
    span = F.struct(F.shiftright("_at", 32).cast("int").alias("first"), F.col("_at").bitwiseAND(0x7FFFFFFF).cast("int").alias("n"))
    by_doc = later.groupBy("_id", "_key").agg(F.collect_set(span).alias("_spans"))
    joined = keyed.alias("d").join(by_doc.alias("s"), F.col("d._id").eqNullSafe(F.col("s._id")) & (F.col("d._key") == F.col("s._key")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 1, BATCH_BYTES):
            texts = rows.column(1).to_pylist()
            layout = Layout([x or "" for x in texts])
            gone = [0] * len(texts)
            for i, held in enumerate(rows.column(2).to_pylist()):
                if held:
                    texts[i], gone[i] = layout.without(i, texts[i], [(x["first"], x["n"]) for x in held])
            yield pa.record_batch([rows.column(0), pa.array(texts, pa.string()), pa.array(layout.n_sentences), pa.array(gone, pa.int64())], [id_col, "text", "n_sentences", "n_removed"])

    return joined.select("d._id", "d._text", "s._spans").mapInArrow(released(cut), f"`{id_col}` {kind}, text string, n_sentences long, n_removed long")

"""LM scoring: cross-entropy difference of a target and a background bigram model.

Both models share one vocabulary, all words of the corpus, one order and one smoothing, and are counted exactly over all documents:
the counts are a distributed table that grows with the corpus.  Texts are dealt out in cells of bounded size.  A cell
sends its own counts of words and pairs of words, in order of their hashes, to ranges of hashes; a range adds up what all cells
send and answers each cell with what the others have.  A document is scored by the counts of all others, so none is
close to a model because it is a part of it.  A document's score is the difference of its losses per token: the
lower, the closer it is to the target.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.hashing import buffers, mix, spans, words

#: Weight of the pair's relative frequency against the word's, and added counts of a word.
BIGRAM_WEIGHT, ADDED = 0.7, 0.05
#: Bytes of text that a cell holds on average; there are more cells where tasks would have less than four.
CELL_BYTES = 8 << 20
#: Bytes of text for which there is one range of items; a range holds about a quarter as many.
RANGE_BYTES = 16 << 20
#: Items other than words and pairs, which are even and odd hashes: all tokens, and documents with words, which are the pairs' context at a text's start.
TOKENS, STARTS = np.uint64(0x5851F42D4C957F2E), np.uint64(0x14057B7EF767814E)
COUNTED = "range int, cell int, items binary, n binary, t binary"
ANSWERED = "cell int, range int, n binary, t binary, ids binary"
SCORED = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def packed(x: np.ndarray) -> bytes:
    """64-bit numbers compressed byte by byte of their places, as the high bytes are mostly alike."""
    import zstandard

    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    import zstandard

    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T).view(np.int64).ravel()


class Cell:
    """Words and pairs of the texts of a cell: each by its place among the cell's distinct ones."""

    def __init__(self, texts: pa.ChunkedArray):
        hashes, begins, at = [], [np.zeros(1, np.int64)], 0
        for chunk in texts.chunks:
            raw, offsets = buffers(chunk)
            for a, b in spans(offsets):
                found, to = words(raw, offsets[a : b + 1])
                hashes.append(found & ~np.uint64(1))
                begins.append(to[1:] + at)
                at += len(found)
        self.begins = np.concatenate(begins)
        self.doc = np.repeat(np.arange(len(self.begins) - 1), np.diff(self.begins))
        self.word_items, self.word = np.unique(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), return_inverse=True)
        size = len(self.word_items)
        self.first = np.zeros(len(self.word), bool)
        self.first[self.begins[:-1][np.diff(self.begins) > 0]] = True
        before = np.where(self.first, size, np.roll(self.word, 1))
        pairs, self.pair = np.unique(before * (size + 1) + self.word, return_inverse=True)
        known = np.append(self.word_items, STARTS)
        self.pair_items = mix(known[pairs // (size + 1)] * np.uint64(0x9E3779B97F4A7C15) + known[pairs % (size + 1)]) | np.uint64(1)

    def items(self, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items in order, their places before that, and where each range begins and the last one ends."""
        items = np.concatenate([self.word_items, self.pair_items, [TOKENS, STARTS]])
        order = np.argsort(items)
        steps = (np.arange(1, ranges, dtype=object) * 2**64 // ranges).astype(np.uint64)
        return items[order], order, np.concatenate([[0], np.searchsorted(items[order], steps), [len(items)]])

    def counts(self, docs: np.ndarray) -> np.ndarray:
        """How often each item occurs in the documents that are marked."""
        own = docs[self.doc]
        started = int((docs & (np.diff(self.begins) > 0)).sum())
        return np.concatenate([np.bincount(self.word[own], minlength=len(self.word_items)), np.bincount(self.pair[own], minlength=len(self.pair_items)), [int(own.sum()), started]])

    def own(self, places: np.ndarray, size: int) -> np.ndarray:
        """For each token, how often its own document has the item of `places` at it."""
        _, back, n = np.unique(self.doc * size + places, return_inverse=True, return_counts=True)
        return n[back]


def _losses(cell: Cell, totals: np.ndarray, docs: np.ndarray, vocabulary: float, weight: float, added: float) -> np.ndarray:
    """Sums over each document of the tokens' negative binary logarithms, by the counts `totals` less the document's own if it is among `docs`."""
    w, p = len(cell.word_items), len(cell.pair_items)
    mine = docs[cell.doc]
    word = totals[cell.word] - mine * cell.own(cell.word, w)
    pair = totals[w + cell.pair] - mine * cell.own(cell.pair, p)
    context = np.where(cell.first, totals[w + p + 1] - mine, np.roll(word, 1))
    size = (totals[w + p] - docs * np.diff(cell.begins))[cell.doc]
    alone = (word + added) / (size + added * vocabulary)
    share = np.where(context > 0, weight * pair / np.maximum(context, 1) + (1 - weight) * alone, alone)
    return np.bincount(cell.doc, -np.log2(share), len(cell.begins) - 1)


def _among(ids: pa.ChunkedArray, wanted: np.ndarray) -> np.ndarray:
    """Which ids are wanted; a null one never is."""
    return np.isin(ids.fill_null(0).to_numpy(), wanted) & ids.is_valid().to_numpy(zero_copy_only=False)


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    kinds = {"range": pa.int32(), "cell": pa.int32()}
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.Table.from_arrays([pa.array(c, kinds.get(k, pa.binary())) for c, k in zip(columns, names, strict=True)], names)


def _sum(key: tuple, rows: pa.Table) -> pa.Table:
    """For each cell of a range, how much more of its items all cells have; rows of ids go on as they are."""
    cells, sent = rows.column("cell").to_pylist(), [unpacked(x) for x in rows.column("items").to_pylist()]
    counts = [rows.column(c).to_pylist() for c in ("n", "t")]
    counted = [i for i, x in enumerate(counts[0]) if x is not None]
    out = [(cells[i], -1, None, None, packed(x)) for i, x in enumerate(sent) if counts[0][i] is None]
    if counted:
        ends = np.cumsum([len(sent[i]) for i in counted])[:-1]
        _, back = np.unique(np.concatenate([np.cumsum(sent[i].view(np.uint64)) for i in counted]), return_inverse=True)
        more = []
        for c in counts:
            own = np.concatenate([unpacked(c[i]) for i in counted])
            more.append(np.split(np.bincount(back, own).astype(np.int64)[back] - own, ends))
        out += [(cells[i], key[0].as_py(), packed(n), packed(t), None) for i, n, t in zip(counted, *more, strict=True)]
    return _table(out, ["cell", "range", "n", "t", "ids"])


def score_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", weight: float = BIGRAM_WEIGHT, added: float = ADDED, cell_bytes: int = CELL_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Columns doc_id, n_tokens, target_loss, background_loss, score: one row per row of `docs`.

    The rows of `docs` whose id stands in `target` (its column `id_col`; repeats and nulls do not count) make the target
    model, all rows the background.  Each row is scored by the counts of the other rows.  A word's chance is `weight` parts its share
    after the word before it and the rest its share of all tokens, with `added` counts for each word there can be, of which there are
    no more than tokens in the corpus; the text's start is a context of its own.  Losses are bits per token, score is
    target_loss - background_loss; all three are null for a text without words (null, empty, blank).  Repeated rows count
    as often as they occur and serve as each other's context; equal texts of one kind score alike.  Very long texts are read
    whole and lie in one cell.  Rows that share one id lie in one cell too, as ids name documents; null ids do not.  An empty table gives no
    rows; other columns are ignored.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = slim.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    cells, ranges = max(-(-total // cell_bytes), 4 * tasks), max(-(-total // range_bytes), tasks)
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(cells)).cast("int").alias("cell")
    placed = slim.select(F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(cells))).otherwise(cell).cast("int").alias("cell"), "doc_id", "text")
    ids = target.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id is not null").distinct().select(cell, "doc_id")

    def count(key: tuple, texts: pa.Table, target: pa.Table) -> pa.Table:
        """A cell's items by range with their counts in all its texts and in those of the target, and the ids of the target."""
        wanted, held, own = np.unique(target.column("doc_id").to_numpy()).astype(np.int64), Cell(texts.column("text")), key[0].as_py()
        items, order, at = held.items(ranges)
        n, t = (held.counts(docs)[order] for docs in (np.ones(texts.num_rows, bool), _among(texts.column("doc_id"), wanted)))
        rows = [(r, own, packed(np.diff(items[a:b], prepend=np.uint64(0))), packed(n[a:b]), packed(t[a:b])) for r, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if a < b]
        return _table([*rows, (own % ranges, own, packed(wanted), None, None)], ["range", "cell", "items", "n", "t"])

    def score(key: tuple, texts: pa.Table, answer: pa.Table) -> pa.Table:
        rows = sorted(zip(*(answer.column(c).to_pylist() for c in ("range", "n", "t", "ids")), strict=True), key=lambda r: r[0])
        marked = _among(texts.column("doc_id"), np.concatenate([unpacked(r[3]) for r in rows if r[3] is not None]))
        held, every = Cell(texts.column("text")), np.ones(texts.num_rows, bool)
        _, order, _ = held.items(ranges)
        totals = []
        for own, c in ((every, 1), (marked, 2)):
            total = held.counts(own).astype(float)
            total[order] += np.concatenate([unpacked(r[c]) for r in rows if r[c] is not None])
            totals.append(total)
        vocabulary, n = totals[0][-2], np.diff(held.begins)
        both = [_losses(held, totals[m], own, vocabulary, weight, added) / np.maximum(n, 1) for m, own in ((1, marked), (0, every))]
        columns = [texts.column("doc_id"), pa.array(n), *(pa.array(x, mask=n == 0) for x in (*both, both[0] - both[1]))]
        return pa.Table.from_arrays(columns, ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    counted = placed.groupBy("cell").cogroup(ids.groupBy("cell")).applyInArrow(count, COUNTED)
    answers = counted.groupBy("range").applyInArrow(_sum, ANSWERED)
    return placed.groupBy("cell").cogroup(answers.groupBy("cell")).applyInArrow(score, SCORED)

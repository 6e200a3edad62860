"""Spelling variants by anagram hashing.

Words and their counts come from the texts in vectorised passes over Arrow buffers; only distinct words leave a task.  A word's anagram key is
the sum of a power of each letter's code, so that words of the same letters share it, and one inserted, deleted or exchanged letter
changes it by that letter's value, or by the difference of two.  Every word offers its own key and its key less the value of each of its letters:
a key that is one word's own and another's less a letter tells an insertion or deletion, one that two words have less a letter tells an exchange.
What is left of the word without the letter is the second half of the join key, which verifies the order of the letters.  So a group holds only words that are
near each other, at most one a letter of the alphabet and place, and no pairs of candidates are made.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import checkpointed, written
from aerolith.llm.hashing import LOWER, buffers, spans

POWER = 5
#: Bytes of texts that are read at once.
SPAN = 4 << 20
#: Words of more letters are told by hashes of their remainders instead of the remainders.
LONG = 64
#: Longer runs, in bytes, are counted one by one.
SLOW = 48
_LEAD = 0xC3  # first of the two bytes of U+00C0 to U+00FF; what follows it is always the second


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of some texts, start and length in bytes of each maximal run of letters, and the text that it lies in."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    text = LOWER[raw[lo:hi]]
    inside = (text >= 97) & (text <= 122)
    lead = text == _LEAD
    inside |= lead
    inside[1:] |= lead[:-1]
    edge = np.zeros(len(text) + 1, bool)
    edge[:-1] = inside
    edge[1:] ^= inside
    cuts = np.unique(offsets - lo)
    split = cuts[(cuts > 0) & (cuts < len(text))]
    split = split[inside[split] & inside[split - 1]]  # runs of two texts that touch
    marks = np.sort(np.concatenate([np.flatnonzero(edge), split, split]))
    starts, ends = marks[::2], marks[1::2]
    return text, starts, ends - starts, np.searchsorted(offsets - lo, starts, "right") - 1


def _crc_and_hash(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, crc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Crc32 of each run, going on from the state `crc`, and a 64-bit hash of it; one byte of all runs at a time, longest runs first."""
    order = np.argsort(-lengths, kind="stable")
    at, crc, h = starts[order], crc[order].astype(np.uint32), np.zeros(len(order), np.uint64)
    left = np.searchsorted(-lengths[order], -np.arange(1, int(lengths.max(initial=0)) + 1), "right")  # runs that have so many bytes
    for j, m in enumerate(left.tolist()):
        byte = text[at[:m] + j]
        crc[:m] = _CRC[(crc[:m] ^ byte) & np.uint32(255)] ^ crc[:m] >> np.uint32(8)
        h[:m] = (h[:m] ^ byte) * np.uint64(0x9E3779B97F4A7C15)
        h[:m] ^= h[:m] >> np.uint64(29)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return ~crc[back], h[back]


def _gather(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The runs as an Arrow string array."""
    to = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=to[1:])
    data = text[np.repeat(starts - to[:-1], lengths) + np.arange(to[-1])]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(to), pa.py_buffer(data)).cast(pa.string())


def edited(run: bytes, crc: int, every: int) -> str:
    """The run without the letter at its crc32 modulo its length, if `every` divides the crc32."""
    word = run.decode()
    at = crc % len(word)
    return word[:at] + word[at + 1 :] if crc % every == 0 else word


def words_of(ids: list, texts: pa.Array, least: int, every: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Distinct words of at least `least` letters and their counts, for each few megabytes of texts."""
    raw, offsets = buffers(texts)
    for a, b in spans(offsets, SPAN):
        if offsets[a] == offsets[b]:
            continue
        text, starts, lengths, owner = runs(raw, offsets[a : b + 1])
        leads = np.zeros(len(text) + 1, np.int32)
        np.cumsum(text == _LEAD, out=leads[1:])
        letters = lengths - (leads[starts + lengths] - leads[starts])
        keep = letters >= least
        starts, lengths, owner = starts[keep], lengths[keep], owner[keep]
        before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids[a:b]], np.uint32)
        slow = lengths > SLOW
        rare: dict[str, int] = {}
        for i in np.flatnonzero(slow).tolist():
            run = text[starts[i] : starts[i] + lengths[i]].tobytes()
            word = edited(run, zlib.crc32(run, int(before[owner[i]])), every)
            rare[word] = rare.get(word, 0) + 1
        starts, lengths, owner = starts[~slow], lengths[~slow], owner[~slow]
        crc, h = _crc_and_hash(text, starts, lengths, ~before[owner])
        hit = crc % np.uint32(every) == 0
        for i in np.flatnonzero(hit).tolist():
            word = edited(text[starts[i] : starts[i] + lengths[i]].tobytes(), int(crc[i]), every)
            rare[word] = rare.get(word, 0) + 1
        _, first, n = np.unique(h[~hit], return_index=True, return_counts=True)
        yield _gather(text, starts[~hit][first], lengths[~hit][first]), n
        if rare := {w: n for w, n in rare.items() if len(w) >= least}:
            yield pa.array(rare, pa.string()), np.array(list(rare.values()), np.int64)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 5, times: int = 3, every: int = 97) -> DataFrame:
    """Columns w, word, n: words that occur `times` times or more; w is a number in the order of the words' code points.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased; of a run in whose text's id and run (`id:run`) `every` divides the
    crc32, one letter is left out.
    """
    name = lambda c: F.col(f"`{c}`")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, n in words_of(batch.column(0).to_pylist(), batch.column(1), least, every):
                yield pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64())], ["word", "n"])

    slim = docs.select(name(id_col).cast("string").alias("id"), name(text_col).cast("string").alias("text"))
    counts = slim.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)
    # UTF-8 sorts as code points do; the number grows from partition to partition and within each.
    counts = checkpointed(counts).repartitionByRange("word").sortWithinPartitions("word")
    return written(counts.select(F.monotonically_increasing_id().alias("w"), "word", "n"))


_RNG = np.random.default_rng(7)
_BASES = [np.uint64(int(x) * 2 + 1) for x in _RNG.integers(2**61, 2**62, 2)]
_CODES = _RNG.integers(1, 2**63, (2, 256), dtype=np.uint64)


def anagram_key(letters: np.ndarray) -> tuple[int, np.ndarray]:
    """The sum of the letters' values, and the values; all wrap modulo 2**64."""
    values = letters.astype(np.int64) ** POWER
    return int(values.sum()), values


def _hash(word: str) -> list[str]:
    letters = np.frombuffer(word.encode("latin-1"), np.uint8)
    halves = []
    for base, codes in zip(_BASES, _CODES, strict=True):
        powers = np.ones(len(letters), np.uint64)
        np.multiply.accumulate(np.full(len(letters) - 1, base, np.uint64), out=powers[1:])
        terms = codes[letters] * powers
        sums = np.zeros(len(letters) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        inverse = np.uint64(pow(int(base), -1, 2**64))
        without = sums[:-1] + (sums[-1] - sums[1:]) * inverse
        halves.append(np.append(without, sums[-1]))
    return [f"{a:016x}{b:016x}" for a, b in zip(*(h.tolist() for h in halves), strict=True)]


def remainders(word: str) -> tuple[str, list[str]]:
    """The word, and what is left of it without each of its letters; 128-bit hashes stand for what is longer than LONG."""
    hashes = _hash(word) if len(word) > LONG else [word]
    short = len(word) - 1 <= LONG
    return hashes[-1], [word[:i] + word[i + 1 :] for i in range(len(word))] if short else hashes[:-1]


def _offers(words: DataFrame) -> DataFrame:
    """Columns key, r, p, w, m for `words` (w, word, n): the key and letters of the word (p = -1) and those without the letter at place p; m is -n.

    lone is false where the letter before is the same one, as what is left is the same, too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                batch = whole.slice(lo, 2048)
                keys, rs, lengths, lone = [], [], [], []
                for word in batch.column("word").to_pylist():
                    letters = np.frombuffer(word.encode("latin-1"), np.uint8)
                    key, values = anagram_key(letters)
                    own, rest = remainders(word)
                    keys += [np.array([key]), key - values]
                    rs.append(own)
                    rs += rest
                    lengths.append(len(word) + 1)
                    lone.append(np.concatenate([[True, True], letters[1:] != letters[:-1]]))
                if lengths:
                    heads = np.cumsum(lengths) - lengths
                    p = np.arange(sum(lengths)) - np.repeat(heads, lengths) - 1
                    w, n = (np.repeat(batch.column(c).to_numpy(), lengths) for c in ("w", "n"))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(rs, pa.string()), pa.array(p), pa.array(w), pa.array(-n), pa.array(np.concatenate(lone))], ["key", "r", "p", "w", "m", "lone"])

    return words.mapInArrow(run, "key long, r string, p long, w long, m long, lone boolean")


def near_counts(words: DataFrame) -> DataFrame:
    """Columns w, n_near, best (m, w): how many words are near, and the one that occurs most often, of equals the smallest."""
    offers = written(_offers(words))
    one = F.struct("m", "w")
    # Words that agree without their letters at one place differ by an exchange there, and are all near each other.
    exchanged = offers.where("p >= 0").groupBy("key", "r", "p").agg(F.sort_array(F.collect_list(one)).alias("xs")).where(F.size("xs") > 1)
    exchanged = exchanged.select("xs", F.posexplode("xs").alias("at", "x"))
    exchanged = exchanged.select("x.w", (F.size("xs") - 1).alias("n"), F.when(F.col("at") == 0, F.col("xs")[1]).otherwise(F.col("xs")[0]).alias("best"))
    # A word that is what another one is without a letter.
    own, more = F.max(F.when(F.col("p") < 0, one)), F.collect_list(F.when(F.col("p") >= 0, one))
    inserted = offers.where("lone").groupBy("key", "r").agg(own.alias("own"), F.sort_array(more).alias("xs")).where(F.col("own").isNotNull() & (F.size("xs") > 0))
    shorter = inserted.select("own.w", F.size("xs").alias("n"), F.col("xs")[0].alias("best"))
    longer = inserted.select(F.explode("xs").alias("x"), "own").select("x.w", F.lit(1).alias("n"), F.col("own").alias("best"))
    return exchanged.unionByName(shorter).unionByName(longer).groupBy("w").agg(F.sum("n").alias("n_near"), F.min("best").alias("best"))


def followed(links: DataFrame) -> DataFrame:
    """Columns w, root: where the links (w, up), which hold no circle, lead in the end; each round doubles the steps."""
    now = checkpointed(links)
    while True:
        further = now.select(F.col("w").alias("up"), F.col("up").alias("next"))
        joined = checkpointed(now.join(further, "up", "left").select("w", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("moved")))
        now = joined.select("w", "up")
        if joined.where("moved").isEmpty():
            return now.select("w", F.col("up").alias("root"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 5, times: int = 3, every: int = 97, ratio: int = 2) -> DataFrame:
    """Columns word, form, root, n, n_near, form_n: one row per word of :func:`vocabulary`.

    Two words are near if one inserted, deleted or exchanged letter parts them.  form is the near word of the largest count (of equals the smallest in code-point
    order) if it occurs `ratio` times as often at least, else null; root is where forms lead in the end.  A null text has no words and a null id counts as the
    empty text; repeated rows count again; texts and runs of any length are read whole (the order of letters in words of more than 64 is told by 128-bit hashes).
    Without words, as in an empty table, there are no rows; other columns of any names are ignored.
    """
    words = vocabulary(docs, id_col, text_col, least, times, every)
    near = near_counts(words)
    best_n = -F.col("best.m")
    known = words.join(near, "w", "left").select("w", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(best_n >= ratio * F.col("n"), F.col("best")).alias("best"))
    known = written(known.select("w", "word", "n", "n_near", F.col("best.w").alias("up"), (-F.col("best.m")).alias("form_n")))
    roots = followed(known.where("up IS NOT NULL").select("w", "up"))
    text = known.select(F.col("w").alias("at"), "word")
    forms = roots.join(known.select("w", "up"), "w").join(text.select(F.col("at").alias("up"), F.col("word").alias("form")), "up")
    forms = forms.join(text.select(F.col("at").alias("root"), F.col("word").alias("root_word")), "root").select("w", "form", "root_word")
    out = known.join(forms, "w", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")

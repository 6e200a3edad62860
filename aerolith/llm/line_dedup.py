"""Line dedup by content-defined windows of lines, with DataFrame functions alone.

A line here ends at a newline or at the blank after a sentence's end, as whole paragraphs often stand on
one physical line.  From each line with words a window goes on, and one goes back, until it is long enough to be
removed; a window's bounds depend on nothing but the lines inside it, so a repeated run holds the same windows wherever it
stands, and every line with words of a run that is long enough lies in one of them.  All windows are looked up by their hash.
Those that occur again are matched with their first occurrence; neighbouring matches form runs, which are compared
byte for byte with the first occurrence and removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import checkpointed, whole_row, written

LINE_END = r"(?<=\n)|(?<=[.!?] )"
#: The key of a null id, and of this id itself.
NO_ID = -(2**63)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), LINE_END)


def _marked(text: Column) -> Column:
    """The text with a newline for each blank after a sentence's end; plain replacements are faster than a pattern."""
    text = F.coalesce(text, F.lit(""))
    for end in ".!?":
        text = F.replace(text, F.lit(f"{end} "), F.lit(f"{end}\n"))
    return text


def _breaks(text: Column) -> Column:
    """The lines of :func:`_lines`, without the newline or blank that ends them."""
    return F.split(_marked(text), "\n")


def _signed(text: Column) -> Column:
    """The lines of :func:`_lines`, each with one more letter that says how it ends: n (newline), b (blank) or x (the last one)."""
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit("n\n"))
    for end in ".!?":
        text = F.replace(text, F.lit(f"{end} "), F.lit(f"{end}b\n"))
    return F.split(F.concat(text, F.lit("x")), "\n")


def _unsigned(lines: Column) -> Column:
    """The text of lines of :func:`_signed`.  Each newline here ends a line, so the letter before it is its sign; newlines of the text come last."""
    text = F.concat(F.array_join(lines, "\n"), F.lit("\n"))
    for sign, end in ("b", " "), ("x", ""), ("n", "\n"):
        text = F.replace(text, F.lit(f"{sign}\n"), F.lit(end))
    return F.when(F.size(lines) > 0, text).otherwise("")


def _count(text: Column) -> Column:
    """How many lines :func:`_lines` gives."""
    return F.size(_breaks(text))


def _part(array: Column | str, start: Column, n: Column) -> Column:
    """`n` entries of an array from place `start` (from 0).  Inside a lambda `slice` copies the whole array first."""
    return F.transform(F.sequence(start, start + n - 1), lambda i: F.get(array, i))


def _bare(lines: Column | str) -> Column:
    return F.transform(lines, lambda x: F.trim(x, F.lit(" \n\r\t")))


def _windows(docs: DataFrame, least_words: int, lone_words: int) -> DataFrame:
    """Columns d (document key), k, a (first line), n (lines), ch (hash): the least windows from and to each line with words.

    With a run [i, j] that is long enough goes each longer one.  So if a line of a run is in no window that starts or ends at
    it and lies in the run, the window from the run's first line passes it and lies in the run.
    """
    # What the split leaves after the last line's end is no line.  Blank lines at a run's edge are taken by windows that also hold the blank lines before or after their last line.
    whole = F.when(F.element_at("lines", -1) == "", F.slice("lines", F.lit(1), F.size("lines") - 1)).otherwise(F.col("lines"))
    lines = docs.select("d", "k", _bare(whole).alias("b"))
    # The line of each word, with that line's words in the lower half: so many entries on or back stands the line that so many words reach.
    word_of = F.flatten(F.transform("b", lambda x, i: F.transform(F.array(_words(x)), lambda w: F.array_repeat(i.cast("long") * 2**32 + w, w))[0]))
    lines = lines.select("d", "k", F.transform("b", lambda x: F.xxhash64(x)).alias("h"), word_of.alias("word_of"))
    # A row for each line with words, by its first word p.  What follows has no lambdas, so that it is compiled.  Without `outer`, a filter on the
    # array's size would be put below, where it computes all of it again.
    lines = lines.select("d", "k", "h", "word_of", F.posexplode_outer("word_of").alias("p", "of"))
    line = lambda of: F.shiftright(of, 32)
    size = lambda of: of.bitwiseAND(F.lit(2**32 - 1)).cast("int")
    of = lambda p: F.get("word_of", p)
    at = lambda p: line(of(p))
    # First and last line in one number.
    span = lambda lo, hi: lo * 2**32 + hi
    lines = lines.where(F.col("p").isNotNull() & ~of(F.col("p") - 1).eqNullSafe(F.col("of")))
    lines = lines.select("d", "k", "h", "word_of", "p", line(F.col("of")).alias("i"), size(F.col("of")).alias("w"), F.size("h").alias("all"))
    i, p, w = F.col("i"), F.col("p"), F.col("w")
    q, last = p + w - 1, F.col("all") - 1
    # Words that reach from the line's first word on, and from its last word back; the line with words before.
    ahead_to, back_to, before = at(p + least_words - 1), at(q - least_words + 1), of(p - 1)

    alone = (w >= least_words) & (w < lone_words)  # needs one more line
    ahead = F.when(w >= lone_words, span(i, i)).when(alone, F.when(i < last, span(i, i + 1))).otherwise(span(i, ahead_to))
    # Windows are listed once: the line of itself is among those ahead, and so is a window back from whose first line no shorter one goes on.
    first = size(of(q - least_words + 1))
    next_to = (line(before) == i - 1) & (size(before) < lone_words)
    blank = F.coalesce(line(before), F.lit(-1)) == i - 2
    same = (first < lone_words) & (((first >= least_words) & (back_to == i - 1)) | (F.coalesce(at(p - least_words), F.lit(-1)) < back_to))
    back = F.when(w >= lone_words, None).when(alone, F.when((i > 0) & ~F.coalesce(next_to, F.lit(False)) & ~blank, span(i - 1, i))).when(~same, span(back_to, i))
    # Blank lines before the line, and after it.
    gap, on = F.coalesce(line(before) + 1, F.lit(0)), F.coalesce(at(q + 1) - 1, last)
    after_blanks = F.when(gap < i, span(gap, ahead_to))
    with_blanks = F.when((on > i) & ~(alone & (on == i + 1)), span(back_to, on))
    found = lines.select("d", "k", "h", F.explode(F.array(ahead, back, after_blanks, with_blanks)).alias("s")).where(F.col("s").isNotNull())
    s = F.col("s")
    found = found.select("d", "k", "h", F.shiftright(s, 32).cast("int").alias("a"), (s.bitwiseAND(F.lit(2**31 - 1)) - F.shiftright(s, 32) + 1).cast("int").alias("n"))
    return found.select("d", "k", "a", "n", F.xxhash64("n", F.slice("h", F.col("a") + 1, F.col("n"))).alias("ch"))


def _runs(windows: DataFrame) -> DataFrame:
    """Columns d, k, a, n, and kd, kk, ka: runs of lines with the place where their windows occur first."""
    # A table of its own, so that a common window's rows in the join can be split among tasks.
    first = written(windows.groupBy("ch").agg(F.min(F.struct("d", "k", "a")).alias("p"), F.count("*").alias("times")).where("times > 1").select("ch", "p"))
    hits = windows.join(first.hint("shuffle_hash"), "ch").where(F.struct("d", "k", "a") != F.col("p"))
    # A document's hits by the distance to their first occurrence, in order (`array_sort` would compare by a lambda); a hit goes on its
    # predecessor's run where both documents go on.
    hit = F.struct(F.col("p.d").alias("kd"), F.col("p.k").alias("kk"), (F.col("a") - F.col("p.a")).alias("off"), "a", "n")
    per = hits.groupBy("d", "k").agg(F.sort_array(F.collect_set(hit)).alias("hits"))

    def follows(x: Column, i: Column) -> Column:
        y = F.get("hits", i - 1)
        return (i > 0) & (y["kd"] == x["kd"]) & (y["kk"] == x["kk"]) & (y["off"] == x["off"]) & (x["a"] <= y["a"] + y["n"])

    per = per.withColumn("heads", F.filter(F.transform("hits", lambda x, i: F.when(~follows(x, i), i)), lambda i: i.isNotNull()))

    def run(i: Column, j: Column) -> Column:
        x = F.get("hits", i)
        members = _part("hits", i, F.coalesce(F.get("heads", j + 1), F.size("hits")) - i)
        end = F.array_max(F.transform(members, lambda y: y["a"] + y["n"]))
        return F.struct(x["a"].alias("a"), (end - x["a"]).alias("n"), x["kd"].alias("kd"), x["kk"].alias("kk"), (x["a"] - x["off"]).alias("ka"))

    runs = per.select("d", "k", F.sort_array(F.transform("heads", run)).alias("runs"))
    # A run inside another one says nothing more.  Of runs with one first line, the longest comes last.
    end = lambda r: r["a"] + r["n"]
    runs = runs.withColumn("out", F.filter("runs", lambda r, i: (i == F.size("runs") - 1) | (F.get("runs", i + 1)["a"] != r["a"])))
    runs = runs.withColumn("out", F.filter("out", lambda r, i: (i == 0) | (end(r) > end(F.get("out", i - 1)))))
    # Nor does a run whose lines the runs before and after it hold between them: near copies of many texts meet in few runs so.
    kind = runs.schema["out"].dataType.simpleString()

    def cover(kept: Column, r: Column) -> Column:
        n = F.size(kept)
        return F.concat(F.when((n >= 2) & (end(F.get(kept, n - 2)) >= r["a"]), F.slice(kept, F.lit(1), n - 1)).otherwise(kept), F.array(r))

    # No array is empty here; a plain `inline` would ask so in a filter below, which computes all of it again.
    return runs.select("d", "k", F.inline_outer(F.aggregate("out", F.array().cast(kind), cover)))


def _words(line: Column) -> Column:
    """Words between blanks; where no two blanks meet and none is at an edge, one more than blanks."""
    blanks = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    pieces = F.size(F.array_remove(F.split(line, " "), ""))
    return F.when((F.instr(line, "  ") > 0) | line.startswith(" ") | line.endswith(" "), pieces).when(line == "", 0).otherwise(blanks + 1)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 25, lone_words: int = 50) -> DataFrame:
    """Columns doc_id, text, n_lines, n_removed: one row per row of `docs`, its text without repeated runs of lines.

    The first occurrence, by id, then text hash, then place, stays; a null id comes first.  A run is removed if it has
    two lines or more and `least_words` words, or one line of `lone_words`, and occurs before; blank lines at its edges may stay.
    Lines are compared without the blanks around them.  A null text stays null, with no lines; equal rows (id and text) are one document and get the same
    result.  An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(_key(id_col), F.xxhash64(F.col(text_col)).alias("k"), F.col(text_col).cast("string").alias("text"))
    doc_id = F.when(F.col("d") != NO_ID, F.col("d"))
    return _deduped(rows, least_words, lone_words).select(doc_id.alias("doc_id"), "text", "n_lines", "n_removed")


def _key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("d")


def _deduped(rows: DataFrame, least_words: int, lone_words: int) -> DataFrame:
    """`rows` (d, k, text and more) with the text changed, and n_lines, n_removed."""
    windows = written(_windows(rows.select("d", "k", _breaks(F.col("text")).alias("lines")), least_words, lone_words))
    runs = checkpointed(_runs(windows))
    # A first occurrence is asked once for each range of lines that is wanted of it.  Both joins with the texts
    # have the same keys, so one shuffle of the texts serves both.
    ranges = runs.groupBy(F.col("kd").alias("d"), F.col("kk").alias("k")).agg(F.collect_set(F.struct("ka", "n")).alias("ranges"))
    asked = rows.join(ranges.hint("shuffle_hash"), ["d", "k"]).select("d", "k", "ranges", _bare(_breaks(F.col("text"))).alias("f"))

    same = lambda r: F.struct(r["ka"].alias("ka"), r["n"].alias("n"), _part("f", r["ka"], r["n"]).alias("same"))
    slices = asked.select(F.col("d").alias("kd"), F.col("k").alias("kk"), "f", "ranges").select("kd", "kk", F.inline_outer(F.transform("ranges", same)))
    lists = runs.join(slices, ["kd", "kk", "ka", "n"]).groupBy("d", "k").agg(F.collect_set(F.struct("a", "n", "same")).alias("runs"))
    joined = rows.join(lists.hint("shuffle_hash"), ["d", "k"], "left")
    joined = joined.withColumn("lines", F.when(F.col("runs").isNotNull(), _signed(F.col("text"))))
    joined = joined.withColumn("b", F.when(F.col("runs").isNotNull(), _bare(_breaks(F.col("text")))))
    # As a variable, lest the optimizer put the expression of b into the lambda, to be evaluated for each run.
    true = F.transform(F.array("b"), lambda b: F.filter("runs", lambda r: _part(b, r["a"], r["n"]) == r["same"]))[0]
    joined = joined.withColumn("spans", F.transform(true, lambda r: F.struct(r["a"].alias("lo"), (r["a"] + r["n"] - 1).alias("hi"))))
    gone = F.flatten(F.transform("spans", lambda s: F.sequence(s["lo"], s["hi"])))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone), lambda i: F.get("lines", i))
    joined = joined.withColumn("left", F.when(F.size("spans") > 0, left))
    n = F.when(F.col("text").isNull(), 0).when(F.col("lines").isNotNull(), F.size("lines")).otherwise(_count(F.col("text"))).cast("long")
    gone = F.when(F.col("left").isNull(), 0).otherwise(F.size("lines") - F.size("left")).cast("long")  # without n, which would be counted twice
    joined = joined.withColumn("n_lines", n).withColumn("n_removed", gone)
    joined = joined.withColumn("text", F.when(F.col("left").isNull(), F.col("text")).otherwise(_unsigned(F.col("left"))))
    # A filter on the new columns must not be pushed below, where it would evaluate their expressions once for each use.
    return joined.select(F.inline(F.array(F.struct(*(c for c in joined.columns if c not in ("runs", "lines", "b", "spans", "left"))))))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars", **options) -> DataFrame:
    """`docs` with repeated runs of lines removed from its texts; documents of which nothing is left go.

    `size_col`, if given, becomes the characters of a changed text; all other columns stay as they are and may have any names.  The
    rules are those of :func:`dedup_lines`: null and empty texts stay, the first occurrence by id, text and place stays, equal rows get the
    same result, texts are read whole at any length, and an empty table stays empty.
    """
    columns = docs.columns
    packed = docs.select(_key(id_col), F.xxhash64(F.col(text_col)).alias("k"), F.col(text_col).cast("string").alias("text"), whole_row(docs, text_col).alias("rest"))
    out = _deduped(packed, options.get("least_words", 25), options.get("lone_words", 50)).where((F.col("n_removed") == 0) | (F.length(F.trim(F.col("text"), F.lit(" \n\r\t"))) > 0))
    size = F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
    return out.select(*(F.col("text").alias(c) if c == text_col else F.coalesce(size, F.col("rest")[c]).alias(c) if c == size_col else F.col("rest")[c].alias(c) for c in columns))

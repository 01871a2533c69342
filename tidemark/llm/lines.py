"""Line dedup by winnowing over line hashes, in DataFrame functions only.

A document is the sequence of its lines that hold a word, without the spaces around them. The
window of a line is the line and as many of the next ones as make at least ``min_words`` words;
near the end of a text, lines that no longer make that many have no window. Each window's
smallest line hash is selected as a fingerprint. Where two places share a run of lines with a
whole window in it, they share the fingerprint, so joining the positions of equal fingerprints
finds every such run, and lines whose fingerprint is met once are dropped at once. Places left
are compared by the hash of the whole window; a window equal to one that begins earlier (in a
smaller doc_id, or before in the same text) is a repeat. All lines covered by repeats are deleted.
The first copy always stays. What is a repeat is judged on the input, not on what is left.

With forward windows alone the last lines of a shared run stay where they make no window.
``whole_runs`` extends every match both ways until lines differ, against every earlier place and
not the first alone: it adds the window that ends in a line, the line and as many of the ones
before as make ``min_words`` words. A line of a shared run with a window in it either has that many
words of the run up to its end, then its backward window repeats, or lies in the forward window of
the run's first line. So lines under repeated windows of both kinds are the maximal runs, and no
pairs of places are made. Only backward windows that are not forward windows too are added.

Rows that are shuffled hold hashes and places; the text moves once, to meet its flags. First
places are minima merged on the map side, and joins back to a common line or passage can be split
by adaptive execution. The only ordered groups are the lines of one text.

Cases: null and empty texts keep their text and have no lines; blank lines are never deleted and
do not interrupt a run; rows with the same doc_id are told apart by their texts, and rows equal in
both are one document; a null doc_id comes before all others. Extra columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import settle

WORD = r"[^\x20\x09-\x0D]+"
EDGES = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"
KEY = ("doc_id", "version")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_windows(docs: DataFrame, min_words: int, whole_runs: bool = False) -> DataFrame:
    """One row per line with words: its place, its window's last line, its fingerprint, and the
    hash of its window (null where the text ends before). With ``whole_runs`` also one row, not
    ``forward``, per backward window that is no forward window, at its first line."""
    lines = docs.select(*KEY, F.posexplode(_lines(F.col("text"))).alias("line", "words"))
    lines = lines.select(*KEY, "line", F.regexp_replace("words", EDGES, "").alias("words")).where("words <> ''")
    lines = lines.select(*KEY, "line", F.unhex(F.md5(F.col("words").cast("binary"))).alias("h"), F.regexp_count("words", F.lit(WORD)).cast("long").alias("n"))
    lines = lines.repartition(*KEY).dropDuplicates([*KEY, "line"])
    order = Window.partitionBy(*KEY).orderBy("line")
    lines = lines.withColumn("before", F.sum("n").over(order) - F.col("n"))
    frame = Window.partitionBy(*KEY).orderBy("before").rangeBetween(0, min_words - 1)
    whole = F.sum("n").over(frame) >= min_words
    digest = lambda f: F.unhex(F.md5(F.array_join(F.transform(F.collect_list("h").over(f), F.hex), "").cast("binary")))
    forward = [
        F.col("line"),
        F.when(whole, F.max("line").over(frame)).alias("last"),
        F.when(whole, F.min("h").over(frame)).alias("fingerprint"),
        F.when(whole, digest(frame)).alias("window"),
        F.lit(True).alias("forward"),
    ]
    if not whole_runs:
        return lines.select(*KEY, *forward)
    lines = lines.withColumn("after", F.col("before") + F.col("n"))
    back = Window.partitionBy(*KEY).orderBy("after").rangeBetween(1 - min_words, 0)
    # without its last line it still has the words: the forward window of its first line is shorter
    longer = F.sum("n").over(back) - F.col("n") >= min_words
    behind = F.when(longer, F.struct(F.min("line").over(back).alias("line"), F.col("line").alias("last"), F.min("h").over(back).alias("fingerprint"), digest(back).alias("window"), F.lit(False).alias("forward")))
    both = lines.select(*KEY, F.array(F.struct(*forward), behind).alias("runs"))
    return both.select(*KEY, F.inline(F.filter("runs", lambda x: x.isNotNull())))


def repeated_windows(windows: DataFrame) -> DataFrame:
    """Places of windows that equal an earlier one."""
    full = windows.where("window is not null")
    met = full.groupBy("fingerprint").agg(
        F.min(F.struct(*KEY, "line")).alias("a"), F.max(F.struct(*KEY, "line")).alias("b")
    )
    candidates = full.join(met.where("a < b").select("fingerprint"), "fingerprint")
    place = F.struct(*KEY, "line")
    first = candidates.groupBy("window").agg(F.min(place).alias("first"))
    return candidates.join(first, "window").where(place > F.col("first")).select(*KEY, "line", "last")


def deleted_lines(docs: DataFrame, min_words: int = 50, whole_runs: bool = False) -> DataFrame:
    """Per document (doc_id, text): its key, and a flag for each line of its text."""
    windows = settle(line_windows(docs, min_words, whole_runs), "windows")
    repeats = repeated_windows(windows)
    r = repeats.select(*[F.col(c).alias(f"r_{c}") for c in (*KEY, "line")], F.col("last").alias("upto"))
    w = windows.where("forward").select(*KEY, "line")
    on = F.col("doc_id").eqNullSafe(F.col("r_doc_id")) & (F.col("version") == F.col("r_version")) & (F.col("line") == F.col("r_line"))
    joined = w.join(r, on, "left").select(*KEY, "line", "upto")
    reach = F.max("upto").over(Window.partitionBy(*KEY).orderBy("line"))
    flagged = joined.select(*KEY, "line", (F.coalesce(reach, F.lit(-1)) >= F.col("line")).alias("gone"))
    return flagged.where("gone").groupBy(*KEY).agg(F.array_sort(F.collect_set("line")).alias("gone"))


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = 50, whole_runs: bool = False) -> DataFrame:
    """All rows and columns of ``docs``; the text without its later repeated runs of lines, with
    ``whole_runs`` without the maximal ones.

    Two columns are added, ``lines_before`` and ``lines_deleted`` (replacing such columns).
    """
    docs = docs.drop("lines_before", "lines_deleted")
    others = [c for c in docs.columns if c != text]  # the text is shuffled once
    own = docs.select(
        (F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(0)).alias("row"),
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.col(f"`{text}`").cast("string").alias("text"),
        F.xxhash64(F.col(f"`{text}`").cast("string")).alias("version"),
    )
    flags = deleted_lines(own.select(*KEY, "text"), min_words, whole_runs)
    f = flags.select(F.col("doc_id").alias("fd"), F.col("version").alias("fv"), "gone")
    joined = own.join(f, F.col("doc_id").eqNullSafe(F.col("fd")) & (F.col("version") == F.col("fv")), "left")
    lines = _lines(F.col("text"))
    # from the sorted places of deleted lines to the runs of lines between them
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    edges = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    kept = F.flatten(
        F.zip_with(
            F.slice(edges, 1, F.size(edges) - 1), F.slice(edges, 2, F.size(edges) - 1),
            lambda a, b: F.slice(lines, a + 2, b - a - 1),
        )
    )
    new = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    count = F.coalesce(F.size(F.filter(lines, lambda x: F.regexp_replace(x, EDGES, "") != "")), F.lit(0))
    return joined.select(
        *[(new if c == text else F.col("row")[c]).alias(c) for c in docs.columns],
        F.when(F.col("text").isNull(), 0).otherwise(count).cast("long").alias("lines_before"),
        F.size(gone).cast("long").alias("lines_deleted"),
    )


SQL = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS line, regexp_replace(parts[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS words
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
       LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)
), counted AS (
  SELECT doc_id, line, words, len(regexp_extract_all(words, '[^\x20\x09-\x0D]+')) AS n FROM lines WHERE words <> ''
), placed AS (
  SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY line) - n AS before FROM counted
), windows AS (
  SELECT doc_id, line, max(line) OVER f AS last, list(words) OVER f AS words, sum(n) OVER f AS n
  FROM placed WINDOW f AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
), firsts AS (
  SELECT doc_id, line, last, n, min((doc_id, line)) OVER (PARTITION BY md5(array_to_string(words, chr(10))), n) AS first FROM windows
), reach AS (
  SELECT doc_id, line, max(CASE WHEN n >= 50 AND (doc_id, line) > first THEN last END) OVER (PARTITION BY doc_id ORDER BY line) AS reach
  FROM firsts
), gone AS (SELECT doc_id, line FROM reach WHERE reach >= line), kept AS (
  SELECT d.doc_id, i - 1 AS line, parts[i] AS words
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL) d,
       LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = d.doc_id AND g.line = i - 1)
)
SELECT d.doc_id AS doc_id,
  CAST(coalesce((SELECT count(*) FROM counted c WHERE c.doc_id = d.doc_id), 0) AS BIGINT) AS n_lines,
  CAST(coalesce((SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id), 0) AS BIGINT) AS n_deleted,
  sha256(coalesce((SELECT string_agg(words, chr(10) ORDER BY line) FROM kept k WHERE k.doc_id = d.doc_id), '')) AS kept_sha256
FROM documents d
"""

#: The same with every match extended to the maximal run: windows forward and backward of each line.
RUNS_SQL = SQL.replace(
    """), firsts AS (""",
    """), backward AS (
  SELECT doc_id, min(line) OVER b AS line, line AS last, list(words) OVER b AS words, sum(n) OVER b AS n
  FROM (SELECT *, before + n AS after FROM placed)
  WINDOW b AS (PARTITION BY doc_id ORDER BY after RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
), both_ways AS (SELECT * FROM windows UNION SELECT * FROM backward), firsts AS (""",
).replace("AS first FROM windows", "AS first FROM both_ways").replace("gone AS (SELECT doc_id", "gone AS (SELECT DISTINCT doc_id")

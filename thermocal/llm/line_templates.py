"""Line dedup with a log-template tree, in DataFrame functions alone.

The tree has a fixed depth: a line goes by its number of tokens, then by its ``depth``
leading tokens, where a token with a digit counts as variable (``<*>``). The lines of a leaf
are one group. The most frequent token of each position after the leading ones (by documents)
makes the group's template; a position whose most frequent token has less than half of the group is
a variable field. Lines that agree with the template in at least ``similar`` of these positions belong
to it. The lines left over are split, each by the most frequent of its tokens that not all of
them hold, and every part is a group again, until no group has two different lines; a line left alone
is a template of its own, its digits variable. Each split fixes one more position, so the rounds end.
A template that occurs in
``min_docs`` documents or more recurs: its first line (least document id, then position)
stays and all others are dropped. A line of ``depth`` tokens or fewer is its leaf, so its exact
recurrence (digits variable) decides. Lines of fewer than ``min_tokens`` tokens and blank lines stay
unexamined; ``min_tokens=1``, as in the query, examines every line that is not blank.

Only hashes and positions move, the tokens of distinct lines of leaves that hold
different lines of several documents, and the texts, once to read those lines and once for the result. Counts are map-side partial aggregates, so a line
that a third of all documents hold is folded before the shuffle.

Defined results: null stays null, with no lines; an empty text has one line; lines end at
``\\n`` alone; null ids sort first; rows equal in id and text are one document, so each of
them gets its result; an empty table gives no rows; other columns pass through, the result is one
struct column that replaces a column of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, dropped, stored

_ENDS = "\x20\x09\x0A\x0B\x0C\x0D"
_DIGITS = r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*"
DOC = ["id", "h"]


def _tokens(raw: Column) -> Column:
    masked = F.when(raw.rlike("[0-9]"), F.regexp_replace(raw, _DIGITS, "<*>")).otherwise(raw)
    return F.split(F.btrim(masked, F.lit(_ENDS)), BLANKS, -1)


def lines(docs: DataFrame, id_col: str, text_col: str, depth: int, min_tokens: int) -> DataFrame:
    """(id, h, pos, tokens, leaf, line) of every line with enough tokens that is not blank; h stands for the text."""
    text = F.col(f"`{text_col}`")
    cut = docs.filter(text.isNotNull()).select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("h"),
                                               F.posexplode(F.split(text, "\n", -1)).alias("pos", "raw"))
    return (cut.select("id", "h", "pos", _tokens(F.col("raw")).alias("tokens")).filter((F.size("tokens") >= min_tokens) & (F.get("tokens", F.lit(0)) != ""))
            .withColumn("leaf", F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth)))
            .withColumn("line", F.xxhash64("tokens")))


def _first():
    return F.struct(*DOC, "pos")


def drop_recurring(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", depth: int = 4, min_tokens: int = 5,
                   similar: float = 0.75, min_docs: int = 2, out: str = "lines") -> DataFrame:
    """``docs`` with a struct ``out``: n_lines, n_dropped, text (the kept lines)."""
    # A tail in which no token may differ makes no other template than the line itself.
    loose = (F.size("tokens") - depth - 1 >= F.lit(similar) * (F.size("tokens") - depth)).alias("loose")
    every = stored(lines(docs, id_col, text_col, depth, min_tokens).select(*DOC, "pos", "leaf", "line", loose), "lines")
    # Leaves that more than one document reaches (min_docs is at least 2).
    doc = F.struct(*DOC)
    leaves = (every.groupBy("leaf").agg(F.min(doc).alias("a"), F.max(doc).alias("b"), F.min("line").alias("p"), F.max("line").alias("q"),
                                         F.max("loose").alias("loose"))
              .filter("a <> b").select("leaf", (F.col("loose") & (F.col("p") != F.col("q"))).alias("mixed")))
    shared = stored(every.drop("loose").join(leaves, "leaf"), "lines-shared")
    dropped(every)
    templates = _templates(docs, shared, id_col, text_col, depth, similar)
    # A template is named by its group, or by its line.
    marked = (shared.join(templates, ["leaf", "line"], "left")
              .withColumn("template", F.when(F.col("group").isNotNull(), F.struct(F.lit(1).alias("g"), F.col("group").alias("t")))
                          .otherwise(F.struct(F.lit(0).alias("g"), F.col("line").alias("t")))).select("template", *DOC, "pos"))
    marked = stored(marked, "lines-marked")
    per_doc = marked.groupBy("template", *DOC).agg(F.min("pos").alias("pos"))
    recurring = (per_doc.groupBy("template").agg(F.count("*").alias("docs"), F.min(_first()).alias("first"))
                 .filter(F.col("docs") >= min_docs).select("template", "first"))
    gone = (marked.join(recurring, "template").filter(~_first().eqNullSafe(F.col("first")))
            .groupBy(*DOC).agg(F.collect_list("pos").alias("gone")))
    keyed = docs.withColumn("__id", F.col(f"`{id_col}`")).withColumn("__h", F.xxhash64(F.col(f"`{text_col}`")))
    gone = gone.select(F.col("id").alias("__gid"), F.col("h").alias("__gh"), F.col("gone").alias("__gone"))
    joined = keyed.join(gone, F.col("__id").eqNullSafe(F.col("__gid")) & (F.col("__h") == F.col("__gh")), "left")
    cut = F.split(F.col(f"`{text_col}`"), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size("__cut") - 1), F.col("__gone"))
    text = F.when(F.col("__gone").isNull(), F.col(f"`{text_col}`")).otherwise(
        F.array_join(F.transform(kept, lambda k: F.get("__cut", k)), "\n"))
    n = F.when(F.col(f"`{text_col}`").isNull(), 0).otherwise(F.size("__cut"))
    return (joined.withColumn("__cut", cut)
            .withColumn(out, F.struct(n.cast("long").alias("n_lines"), F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
                                      text.alias("text")))
            .drop("__id", "__h", "__gid", "__gh", "__gone", "__cut"))


def _templates(docs: DataFrame, shared: DataFrame, id_col: str, text_col: str, depth: int, similar: float) -> DataFrame:
    """(leaf, line, group) of the distinct lines of mixed leaves that fit a template, which its group names."""
    once = shared.filter("mixed").groupBy("leaf", "line", *DOC).agg(F.min("pos").alias("pos"))
    held = once.groupBy("leaf", "line").agg(F.count("*").alias("docs"), F.min(_first()).alias("at"))
    picks = (held.groupBy(F.col("at.id").alias("pid"), F.col("at.h").alias("ph"))
             .agg(F.collect_list(F.struct("leaf", "line", "docs", F.col("at.pos").alias("pos"))).alias("picks")))
    # the text of a line comes from the first document that holds it
    text = F.col(f"`{text_col}`")
    texts = docs.filter(text.isNotNull()).select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    cut = (texts.join(picks, F.col("id").eqNullSafe(F.col("pid")) & (F.col("h") == F.col("ph")))
           .select("picks", F.split("text", "\n", -1).alias("cut")))
    # "cut" is named twice, so that the optimizer does not split the text anew for each line
    with_text = F.transform("picks", lambda p: F.struct(p["leaf"].alias("leaf"), p["line"].alias("line"), p["docs"].alias("docs"),
                                                        F.when(p["pos"] < F.size("cut"), F.get("cut", p["pos"])).alias("raw")))
    picked = cut.select(F.explode(with_text).alias("p")).select("p.*").dropDuplicates(["leaf", "line"])
    rest = stored(picked.select("leaf", "line", "docs", _tokens(F.col("raw")).alias("tokens"))
                  .select(F.col("leaf").alias("group"), "leaf", "line", "docs",
                          F.slice("tokens", depth + 1, F.size("tokens")).alias("tail")), "lines-rest")
    found = rest.limit(0).select("leaf", "line", "group")
    while not rest.isEmpty():
        judged = stored(_judged(rest, similar), "lines-judged")
        found = found.unionAll(judged.filter("member").select("leaf", "line", "group"))
        dropped(rest)
        rest = stored(_split(judged.filter("not member").drop("member")), "lines-rest")
    return found


def _judged(rest: DataFrame, similar: float) -> DataFrame:
    """``rest`` with member: does the line fit the template of its group?"""
    tokens = rest.select("group", "docs", F.posexplode("tail").alias("k", "token"))
    top = (tokens.groupBy("group", "k", "token").agg(F.sum("docs").alias("docs"))
           .groupBy("group", "k").agg(F.max(F.struct("docs", "token")).alias("top"), F.sum("docs").alias("all")))
    template = top.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("k", F.when(F.col("top.docs") * 2 >= F.col("all"), F.col("top.token"))
                                                                              .alias("token")))).alias("template"))
    agree = F.size(F.filter(F.zip_with("tail", "template", lambda a, b: a == b["token"]), lambda x: x))
    return (rest.join(template, "group")
            .select("group", "leaf", "line", "docs", "tail", (agree >= F.size("tail") * F.lit(similar)).alias("member")))


def _split(left: DataFrame) -> DataFrame:
    """The lines left over by their groups' templates, in smaller groups: a line goes by the most frequent of its tokens
    that not all of its group hold. A group of one line is done: that line is a template of its own."""
    tokens = left.select("group", "line", "docs", F.posexplode("tail").alias("k", "token"))
    common = (tokens.groupBy("group", "k", "token").agg(F.sum("docs").alias("n"))
              .join(left.groupBy("group").agg(F.sum("docs").alias("whole")), "group").filter("n < whole").drop("whole"))
    best = (tokens.join(common, ["group", "k", "token"]).groupBy("group", "line")
            .agg(F.max(F.struct("n", (-F.col("k")).alias("k"), "token")).alias("best")))
    parts = (left.join(best, ["group", "line"])
             .select(F.xxhash64("group", "best.k", "best.token").alias("group"), "leaf", "line", "docs", "tail"))
    several = parts.groupBy("group").agg(F.min("line").alias("p"), F.max("line").alias("q")).filter("p <> q").select("group")
    return parts.join(several, "group", "left_semi")

"""Secret scans with corpus-wide ownership frequency, in DataFrame functions alone.

Base kinds, leftmost and non-overlapping each: ``assign`` (a key word, a separator and a
value of 6 or more characters), ``access`` (AKIA and upper-case letters or digits, 20 or more
characters), ``hex`` (24 or more lower-case hexadecimal digits). The spans of a kind are the
running sums of what ``split`` leaves between the matches and of the matches' lengths.

The method adds the kind ``owned``: runs of 32 or more letters, digits, ``+``, ``/``, ``_``, ``-``
with at least one letter and one digit that touch no base span. Every candidate
(base ones by their secret part, the others whole) is hashed, and the hashes are counted
over the whole corpus by distinct repositories and owners. A candidate found with more than
``max_owners`` owners is a widely copied example; the others are specific to their owner and look
live. ``owned`` candidates become spans only if they look live; base spans always stay.
Each span carries its verdict and its counts.

Defined results: null and empty texts have no spans; a null repository or owner counts as
one of its own; rows may repeat (the same owner counts once); no candidates: no counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: The kinds' patterns, in the order that spans of one start are listed in.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
OWNED = r"[A-Za-z0-9+/_-]{32,}"
KINDS = ["assign", "access", "hex", "owned"]

_SPAN = "array<struct<start:bigint,kind:int,end:bigint,secret:string>>"


def _spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Spans of the matches whose ``group`` has ``least`` characters or more."""
    p = F.lit(pattern)
    found = F.regexp_extract_all(text, p, F.lit(0))
    secret = F.regexp_extract_all(text, p, F.lit(group)) if group else found
    # the text between matches, up to the last one
    gaps = F.transform(F.split(text, pattern, -1), lambda s: F.length(s).cast("long"))
    pairs = F.zip_with(F.zip_with(found, secret, lambda m, s: F.struct(F.length(m).cast("long").alias("n"), s.alias("s"))),
                       F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(g.alias("g"), m["n"].alias("n"), m["s"].alias("s")))
    none = F.expr(f"cast(array() as {_SPAN})")
    run = F.aggregate(pairs, F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")), lambda acc, m: F.struct(
        (acc["at"] + m["g"] + m["n"]).alias("at"),
        F.concat(acc["out"], F.array(F.struct((acc["at"] + m["g"]).alias("start"), F.lit(kind).alias("kind"),
                                              (acc["at"] + m["g"] + m["n"]).alias("end"), m["s"].alias("secret")))).alias("out")))
    spans = F.when(F.regexp_like(text, p), run["out"]).otherwise(none)
    return F.filter(spans, lambda s: F.length(s["secret"]) >= least) if least else spans


def candidates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", repo_cols: tuple[str, ...] = ("source", "lang"),
               owner_col: str = "source") -> DataFrame:
    """(id, repo, owner, base, owned) for each row: the spans of the base kinds, sorted, and the
    runs that touch none of them."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("null"))
    found = docs.select(F.col(f"`{id_col}`").alias("id"), F.concat_ws("\x1f", *[part(c) for c in repo_cols]).alias("repo"),
                        part(owner_col).alias("owner"),
                        F.array_sort(F.concat(_spans(text, ASSIGN, 0, 2, 6), _spans(text, ACCESS, 1), _spans(text, HEX, 2))).alias("base"),
                        _spans(text, OWNED, 3).alias("runs"))
    free = F.filter("runs", lambda r: F.regexp_like(r["secret"], F.lit("[0-9]")) & F.regexp_like(r["secret"], F.lit("[A-Za-z]"))
                    & ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return found.withColumn("owned", free).drop("runs")


def scan(docs: DataFrame, *, max_owners: int = 1, **columns) -> DataFrame:
    """One row per document: id, base and spans, sorted arrays of (start, kind, end, secret, n_repos, n_owners, live)."""
    found = stored(candidates(docs, **columns).withColumn("row", F.monotonically_increasing_id()), "secret-candidates")
    every = (found.select("row", "repo", "owner", F.explode(F.concat("base", "owned")).alias("s"))
             .withColumn("hash", F.sha2(F.col("s.secret"), 256)))
    # Distinct first, so a secret that a third of all rows hold is folded before it moves; owners
    # and repositories are then counted from rows that are already distinct.
    seen = every.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    by_owner = seen.groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    counts = by_owner.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))
    judged = every.join(counts, "hash").withColumn("live", F.col("n_owners") <= max_owners)
    kept = judged.filter((F.col("s.kind") != 3) | F.col("live"))
    span = F.struct(*[F.col(f"s.{c}").alias(c) for c in ("start", "kind", "end", "secret")], "n_repos", "n_owners", "live")
    spans = kept.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    return (found.join(spans, "row", "left")
            .select("id", "base", F.coalesce("spans", F.expr("array()")).alias("spans")))


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined; spans are sorted by start, then kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"),
                                                                s["end"].cast("string"))), ",")

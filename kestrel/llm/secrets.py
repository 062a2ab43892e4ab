"""Secret scan: find credential-like strings and judge them by who else has them.

Pattern matches give candidate strings with their spans.  Each candidate is
hashed and counted over the corpus: in how many repositories and by how many
owners it occurs.  A string that several owners hold in several repositories is
a copied example; one of few owners, or of one repository that many share, looks
live.  Long mixed-character strings outside the
patterns are reported only when they look live (kind ``opaque``).

DataFrame functions only.  The texts are scanned where they are; only
candidates are shuffled, and counts are taken over distinct (hash, owner) and
(hash, repository) pairs, so a string copied into a third of all documents is
combined before it reaches its group.

Spans: ``split`` gives the lengths between matches, a running sum per document
and kind gives the code-point positions.

Defined results: a null text is empty; documents without candidates keep their
row with zero counts and empty spans; a null owner or repository counts as one
owner or repository of its own; rows that agree in id and text get the same
result each; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.scratch import written


def _any_case(words: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


ASSIGN = ("(" + _any_case("password|passwd|secret|token|api_?key") + ")"
          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: kind -> (pattern, group of the secret, its least length); in the order of equal starts.
#: access and hex state their least length in the pattern, which finds the same spans.
BASE: Mapping[str, tuple[str, int, int]] = {
    "assign": (ASSIGN, 2, 12),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
OPAQUE = r"[A-Za-z0-9+/_-]{20,}"
KINDS = [*BASE, "opaque"]
#: a string held by at least so many owners, in at least so many repositories, is a copied example
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 3
#: code points of the pieces that a text to be redacted is cut into
PIECE = 1_024


def _found(text: Column, kind: str, pattern: str) -> Column:
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    return F.struct(F.lit(kind).alias("kind"), matches.alias("matches"),
                    F.when(F.size(matches) > 0, gaps).alias("gaps"))


def _keyed(docs: DataFrame) -> DataFrame:
    """A row's key in joins: its id and a hash of its text."""
    return docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                             "__tie": F.coalesce(F.xxhash64("text"), F.lit(0))})


def candidates(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """(__id, __tie, owner, repo, kind, start, end, hash) of every candidate;
    positions in code points, end exclusive."""
    text = F.coalesce(F.col("text"), F.lit(""))
    patterns = {k: p for k, (p, _, _) in BASE.items()} | {"opaque": OPAQUE}
    held = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0"))
    rows = (_keyed(docs).select("__id", "__tie", held(owner).alias("owner"), held(repository).alias("repo"),
                                F.explode(F.array(*[_found(text, k, p) for k, p in patterns.items()])).alias("f"))
            .select("__id", "__tie", "owner", "repo", "f.kind", "f.matches", "f.gaps")
            .where(F.size("matches") > 0)
            .dropDuplicates(["__id", "__tie", "kind", "owner", "repo"]))
    one = Window.partitionBy("__id", "__tie", "kind", "owner", "repo").orderBy("i")
    spans = (rows.select("__id", "__tie", "owner", "repo", "kind",
                         F.posexplode(F.arrays_zip("matches", "gaps")).alias("i", "m"))
             .select("*", F.col("m.matches").alias("match"), F.col("m.gaps").alias("gap")).drop("m")
             .withColumn("end", F.sum(F.col("gap") + F.coalesce(F.length("match"), F.lit(0)))
                         .over(one.rowsBetween(Window.unboundedPreceding, 0)))
             .where("match is not null")
             .withColumn("start", F.col("end") - F.length("match"))
             .withColumn("value", F.when(F.col("kind") == "assign", F.regexp_extract("match", ASSIGN, 2))
                         .otherwise(F.col("match"))))
    mixed = (F.col("match").rlike("[A-Z]") & F.col("match").rlike("[a-z]") & F.col("match").rlike("[0-9]"))
    long_enough = F.lit(False)
    for kind, (_, _, least) in BASE.items():
        long_enough = long_enough | ((F.col("kind") == kind) & (F.length("value") >= least))
    return (spans.where(long_enough | ((F.col("kind") == "opaque") & mixed))
            .select("__id", "__tie", "owner", "repo", "kind", "start", "end",
                    F.sha2("value", 256).alias("hash")))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_repos, n_owners) over the corpus."""
    def count(c: str, name: str) -> DataFrame:
        return found.select("hash", c).distinct().groupBy("hash").agg(F.count("*").alias(name))
    return count("repo", "n_repos").join(count("owner", "n_owners"), "hash")


def scan_spans(docs: DataFrame, owner: str = "source", repository: str = "doc_id",
               example_owners: int = EXAMPLE_OWNERS,
               example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """One row per document that has candidates (__id, __tie): ``__found``, an
    array of (start, rank, kind, end, live, n_owners, n_repos) in order.  What
    falls short of either count is live."""
    found = written(candidates(docs, owner, repository), "candidates")
    owned = written(ownership(found), "ownership")
    live = (F.col("n_owners") < example_owners) | (F.col("n_repos") < example_repositories)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    return (found.join(owned, "hash")
            .where((F.col("kind") != "opaque") | live)
            .select("__id", "__tie", F.struct("start", rank.alias("rank"), "kind", "end", live.alias("live"),
                                            "n_owners", "n_repos").alias("s"))
            .groupBy("__id", "__tie").agg(F.array_sort(F.array_distinct(F.collect_list("s"))).alias("__found")))


def scan_secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id",
                 example_owners: int = EXAMPLE_OWNERS,
                 example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """``docs`` with ``__found`` (see ``scan_spans``; empty array for none)."""
    spans = scan_spans(docs, owner, repository, example_owners, example_repositories)
    return (_keyed(docs).join(spans, ["__id", "__tie"], "left").drop("__id", "__tie")
            .withColumn("__found", F.coalesce("__found", F.array().cast(spans.schema["__found"].dataType))))


def digest(scanned: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example)
    of a scanned table."""
    def line(keep: Column) -> Column:
        return F.array_join(F.transform(keep, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    found = F.col("__found")
    base = F.filter(found, lambda s: s["kind"] != "opaque")
    count = lambda f: F.size(F.filter(found, f)).cast("long")
    of_kind = lambda k: count(lambda s: s["kind"] == k)
    return scanned.select(
        "doc_id", *[of_kind(k).alias(f"n_{k}") for k in BASE],
        F.sha2(line(base), 256).alias("base_sha256"), line(found).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"), count(lambda s: ~s["live"]).alias("n_example"))


def _between(pieces: Column, lo: Column, hi: Column) -> Column:
    """Code points [lo, hi) of the text whose pieces these are: at most the two
    pieces at the ends are cut, so the cost is what is copied, not the place."""
    def piece(at: Column) -> Column:
        return F.coalesce(F.get(pieces, at.cast("int")), F.lit(""))
    first, last = F.floor(lo / PIECE), F.floor(hi / PIECE)
    lo, hi = lo - first * PIECE, hi - last * PIECE
    inner = F.slice(pieces, (first + 2).cast("int"), F.greatest(last - first - 1, F.lit(0)).cast("int"))
    return (F.when(first == last, F.substring(piece(first), (lo + 1).cast("int"), (hi - lo).cast("int")))
            .otherwise(F.concat(F.substring(piece(first), (lo + 1).cast("int"), F.lit(PIECE)), F.array_join(inner, ""),
                                F.substring(piece(last), F.lit(1), hi.cast("int")))))


def redact(docs: DataFrame, owner: str = "source", repository: str = "doc_id",
           example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES,
           mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every live-looking span of ``text`` replaced by ``mark``
    (overlapping spans by one) and ``n_chars``, if there, counted again.

    Spans that overlap are joined to runs in a row per span, ordered by a window;
    a document's runs and the text between them are put together once."""
    spans = scan_spans(docs, owner, repository, example_owners, example_repositories)
    live = (spans.select("__id", "__tie", F.explode(F.filter("__found", lambda s: s["live"])).alias("s"))
            .select("__id", "__tie", "s.start", "s.end"))
    order = Window.partitionBy("__id", "__tie").orderBy("start", "end")
    upto = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (upto.isNull() | (F.col("start") >= upto)).cast("int")
    runs = (live.withColumn("opens", opens)
            .withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("__id", "__tie", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    # the text before each run, and after the last: [end of the one before, start of this)
    one = Window.partitionBy("__id", "__tie").orderBy("start")
    gaps = (runs.withColumn("lo", F.coalesce(F.lag("end").over(one), F.lit(0)))
            .groupBy("__id", "__tie")
            .agg(F.array_sort(F.collect_list(F.struct("lo", F.col("start").alias("hi")))).alias("__gaps"),
                 F.max("end").alias("__last")))
    scanned = _keyed(docs).join(gaps, ["__id", "__tie"], "left").withColumn(
        "__pieces", F.when(F.col("__gaps").isNotNull(),
                           F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % PIECE), F.lit(0))))
    pieces = F.col("__pieces")
    kept = F.concat(F.transform("__gaps", lambda g: _between(pieces, g["lo"], g["hi"])),
                    F.array(_between(pieces, F.col("__last"), F.length("text"))))
    out = scanned.withColumn("__text", F.when(F.col("__gaps").isNotNull(), F.array_join(kept, mark))
                             .otherwise(F.col("text")))
    names = docs.columns
    cols = {"text": F.col("__text")}
    if "n_chars" in names:
        cols["n_chars"] = F.when(F.col("text").eqNullSafe(F.col("__text")), F.col("n_chars")).otherwise(
            F.length("__text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in names])

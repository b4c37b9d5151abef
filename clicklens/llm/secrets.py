"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

Every match of a kind's pattern is a span (code points, end exclusive). The
matched values' hashes are counted over the whole corpus by distinct
repositories and owners: a value that ``EXAMPLE_OWNERS`` or more owners carry is a
widely copied example, one that fewer owners carry and that looks random is
owner-specific and live-looking. Provider-shaped keys are added to the base
kinds.

Counting goes through partial aggregates (value, owner, repository), so a value
that a third of all rows carry is reduced in every task before the shuffle;
the join back to the matches is one AQE can split.

Defined cases: null and empty texts have no spans; null repositories or owners
count as one of their own; repeated rows are reported alike and count as one
repository; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# fixed values: the contract's base patterns, and public key shapes
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # runs of 24 or more; shorter runs would be dropped
PROVIDER = (r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|[sr]k_live_[A-Za-z0-9]{16,}"
            r"|AIza[A-Za-z0-9_-]{35}|-----BEGIN [A-Z ]*PRIVATE KEY-----")
# a private key up to its END line; without one, the lines of key text that follow
KEY_REST = (r"(?:[^-]*+(?:-{1,4}[^-]++)*+-----END [A-Z ]*PRIVATE KEY-----|(?:\s++[A-Za-z0-9+/=]{16,})*+)")
KINDS = {"assign": (ASSIGN, 2, 6), "access": (ACCESS, 0, 20), "hex": (HEX, 0, 24), "provider": (PROVIDER, 0, 1)}
WHOLE_KEYS = KINDS | {"provider": (PROVIDER + KEY_REST, 0, 1)}  # the key is the last alternative
BASE = ("assign", "access", "hex")
ANY = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}|gh[pousr]_|xox[abprs]-|[sr]k_live_|AIza|-----BEGIN "
EXAMPLE_OWNERS = 3
LIVE_CHARACTERS = 8  # distinct characters of a live-looking value


def matches(docs: DataFrame, kinds: dict = KINDS) -> DataFrame:
    """One row per span: ``doc_id, text_key, repo, owner, rank, kind, start,
    stop, value`` (which ends the span) from ``docs(doc_id, text, text_key, repo, owner)``."""
    hit = docs.where(F.col("text").rlike(ANY)).dropDuplicates(["doc_id", "text_key"])
    all_kinds = F.array(*(F.struct(
        F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), F.lit(least).alias("least"),
        F.split("text", pattern, -1).alias("between"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all("text", F.lit(pattern), F.lit(group)).alias("value"))
        for rank, (kind, (pattern, group, least)) in enumerate(kinds.items())))
    each = hit.select("doc_id", "text_key", "repo", "owner", F.explode(all_kinds).alias("k")).where("size(k.found) > 0")
    one = each.select("doc_id", "text_key", "repo", "owner", "k.rank", "k.kind", "k.least", F.posexplode(F.arrays_zip(
        F.col("k.found").alias("found"), F.col("k.value").alias("value"),
        F.slice("k.between", F.lit(1), F.size("k.found")).alias("between"))).alias("n", "m"))
    before = W.partitionBy("doc_id", "text_key", "rank").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    stop = F.sum(F.length("m.between") + F.length("m.found")).over(before)
    return one.withColumn("stop", stop).withColumn("start", F.col("stop") - F.length("m.found")).where(
        F.length("m.value") >= F.col("least")).select(
        "doc_id", "text_key", "repo", "owner", "rank", "kind", "start", "stop", F.col("m.value").alias("value"))


def ownership(found: DataFrame) -> DataFrame:
    """``key, n_repos, n_owners`` per value hash over the whole corpus."""
    part = found.select("key", "owner", "repo").distinct().groupBy("key", "owner").agg(F.count("*").alias("repos"))
    return part.groupBy("key").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))))


def keyed_docs(docs: DataFrame, repo_col: str, owner_col: str) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.col(repo_col).cast("string").alias("repo"),
        F.col(owner_col).cast("string").alias("owner")).withColumn("text_key", F.xxhash64("text"))


def verdicts(keyed: DataFrame, kinds: dict = KINDS) -> DataFrame:
    """``d, t, found``: the judged spans of each (doc_id, text_key) that has
    some, in order."""
    found = matches(keyed, kinds).withColumn("key", F.sha2(F.col("value").cast("binary"), 256))
    judged = found.join(ownership(found), "key").withColumn("example", F.col("n_owners") >= EXAMPLE_OWNERS).withColumn(
        "live", ~F.col("example") & F.col("value").rlike("[0-9]")
        & (F.size(F.array_distinct(F.split("value", ""))) >= LIVE_CHARACTERS))
    span = F.struct("start", "rank", "kind", "stop", "live", "example", (F.col("stop") - F.length("value")).alias("value_start"))
    lists = judged.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(span)).alias("found"))
    return lists.withColumnsRenamed({"doc_id": "d", "text_key": "t"})


def scan(docs: DataFrame, repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """Per row of ``docs``: counts, digest of the base spans, all spans as
    text and as an array, and how many values are live-looking or examples."""
    keyed = keyed_docs(docs, repo_col, owner_col)
    lists = verdicts(keyed)
    rows = keyed.select("doc_id", "text_key").join(
        lists, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left")
    spans = F.coalesce("found", F.expr(
        "cast(array() as array<struct<start:bigint,rank:int,kind:string,stop:bigint,live:boolean,example:boolean,value_start:bigint>>)"))
    out = rows.select("doc_id", "text_key", spans.alias("found"))

    def count(test) -> Column:
        return F.size(F.filter("found", test)).cast("long")

    base = F.filter("found", lambda x: x["kind"] != "provider")
    return out.select(
        "doc_id", *(count(lambda x: x["kind"] == k).alias(f"n_{k}") for k in BASE),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
        count(lambda x: x["live"]).alias("n_live"), count(lambda x: x["example"]).alias("n_example"), "found", "text_key")


def redact(docs: DataFrame, mark: str = "[SECRET]", repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """``docs`` with the value of every span, as ``scan`` finds and judges it
    (private keys up to their END line), replaced by ``mark`` in ``text`` and
    ``n_chars`` brought up to date; all rows and columns stay. Names before
    values stay, and so do widely copied examples, which are nobody's secret;
    values that only do not look random go like live ones."""
    lists = verdicts(keyed_docs(docs, repo_col, owner_col), WHOLE_KEYS).withColumnsRenamed(
        {"d": "__d", "t": "__t", "found": "__found"})
    text = F.col("text")
    rows = docs.join(lists, F.col("doc_id").cast("long").eqNullSafe(F.col("__d"))
                     & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__t")), "left")
    spans = F.sort_array(F.transform(F.filter("__found", lambda x: ~x["example"]), lambda x: F.struct(
        x["value_start"].cast("int").alias("start"), x["stop"].cast("int").alias("stop"))))
    cut = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, x: F.struct(F.greatest(a["at"], x["stop"]).alias("at"), F.when(x["start"] < a["at"], a["out"]).otherwise(
            F.concat(a["out"], F.substring(text, a["at"] + 1, x["start"] - a["at"]), F.lit(mark))).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    out = rows.withColumn("text", F.when(F.col("__found").isNotNull(), cut).otherwise(text)).select(docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out

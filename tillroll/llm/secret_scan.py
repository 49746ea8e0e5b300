"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found in every whole text, their secrets hashed, and the hashes
counted by distinct repositories and owners over the corpus.  A secret that
several owners hold is a widely copied example; one that a single owner holds
and that looks like a real credential is reported as live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

# The kinds in their order, pattern and least length of the secret.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # as AKIA[A-Z0-9]+ with 20 characters or more: a shorter run holds no longer match
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGN = 6
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your|test|xxxx|1234567|abcdef"
LEAST_DISTINCT = 8


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pieces(pattern: str, kind: int) -> Column:
    """Matches in order, each with the length of the text between it and the one before.

    The text is cut at its matches, so gaps and matches alternate and a running
    sum of their lengths gives every position; nothing is searched for again.
    """
    match = f"x.`_m{kind}`"
    secret = f"regexp_extract({match}, {_quoted(pattern)}, 2)" if kind == 0 else match
    return F.expr(f"""
        transform(arrays_zip(slice(split(_text, {_quoted(pattern)}, -1), 1, size(_m{kind})), _m{kind}), (x, i) -> named_struct(
          'kind', {kind}, 'i', i, 'gap', char_length(x.`0`), 'len', char_length({match}), 'secret', {secret}))""")


def find(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``pieces``: every match of every whole text, by kind and in order.

    Per kind the matches are leftmost and do not overlap; an assignment whose
    value is too short uses up its text too.  Null texts are empty.
    """
    df = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    patterns = (ASSIGN, ACCESS, HEX)
    df = df.select(*keep, "_text", *[F.regexp_extract_all("_text", F.lit(p), F.lit(0)).alias(f"_m{k}") for k, p in enumerate(patterns)])
    pieces = [_pieces(p, k) for k, p in enumerate(patterns)]
    none = F.expr("cast(array() as array<struct<kind:int,i:int,gap:int,len:int,secret:string>>)")
    found = [F.when(F.size(f"_m{k}") > 0, p).otherwise(none) for k, p in enumerate(pieces)]
    return df.select(*keep, F.concat(*found).alias("pieces"))


def candidates(found: DataFrame, row: str, keep: list[str]) -> DataFrame:
    """One row per candidate of ``found`` (with ``pieces``): ``row``, ``keep``, kind, start, end (exclusive), secret."""
    each = found.filter(F.size("pieces") > 0).select(row, *keep, F.inline("pieces"))
    so_far = Window.partitionBy(row, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)  # the matches of one text
    each = each.withColumn("end", F.sum(F.col("gap").cast("bigint") + F.col("len")).over(so_far))
    each = each.select(row, *keep, "kind", (F.col("end") - F.col("len")).alias("start"), "end", "secret")
    return each.filter((F.col("kind") > 0) | (F.length("secret") >= LEAST_ASSIGN))


def live_looking(secret: Column) -> Column:
    """Varied enough for a generated credential and without the words of placeholders."""
    return (F.size(F.array_distinct(F.split(secret, ""))) >= LEAST_DISTINCT) & ~secret.rlike(PLACEHOLDER)


def ownership(candidates: DataFrame, repo: str, owner: str, secret: str = "secret") -> DataFrame:
    """(secret_hash, n_found, n_repositories, n_owners) over the whole corpus.

    Counted in two steps, by (hash, owner, repository) and then by hash, so
    that a secret in a third of all rows is summed before it is shuffled.  Null
    owners and repositories count as one owner or repository of their own.
    """
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\x00"))
    one = candidates.groupBy(F.sha2(secret, 256).alias("secret_hash"), none(owner).alias("_owner"), none(repo).alias("_repo"))
    one = one.agg(F.count("*").alias("_n"))
    by_owner = one.groupBy("secret_hash", "_owner").agg(F.sum("_n").alias("_n"), F.count("*").alias("_repos"))
    return by_owner.groupBy("secret_hash").agg(
        F.sum("_n").alias("n_found"), F.sum("_repos").alias("n_repositories"), F.count("*").alias("n_owners")
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo: Column | None = None,
    owner: Column | None = None,
    copied_owners: int = 2,
) -> DataFrame:
    """One row per row of ``docs``: counts and spans of its secrets and how the corpus shares them.

    n_assign, n_access, n_hex; spans and base_sha256 as ``kind:start:end``;
    n_copied: spans whose secret ``copied_owners`` owners or more hold;
    n_live: spans of a secret with fewer owners that looks live; n_placeholder:
    the rest; classes: ``kind:start:end:class``; max_owners and
    max_repositories of its secrets (0 without any).

    Owner is ``source`` and a repository is a source's documents of one
    language, unless given.  Empty and null texts have no spans; null ids,
    owners and repositories are values of their own; each repeated row gets its
    own row, and counts; an empty table gives no rows.  A very long text, or one
    with very many secrets, takes time in proportion.  Other columns are not read.
    """
    owner = F.col("source") if owner is None else owner
    repo = F.concat_ws("/", "source", "lang") if repo is None else repo
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"), owner.alias("_owner"), repo.alias("_repo"))
    found = find(rows, ["_id", "_owner", "_repo"], "_t").withColumn("_row", F.monotonically_increasing_id())
    found = staged(found, "secrets")  # fixes _row
    each = candidates(found, "_row", ["_owner", "_repo"])
    freq = ownership(each, "_repo", "_owner")
    rated = each.withColumn("secret_hash", F.sha2("secret", 256)).join(freq, "secret_hash")
    kind = F.when(F.col("n_owners") >= copied_owners, "copied").when(live_looking(F.col("secret")), "live").otherwise("placeholder")
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    place = F.concat_ws(":", name, F.col("start").cast("string"), F.col("end").cast("string"))
    rated = rated.select("_row", "kind", kind.alias("class"), "n_owners", "n_repositories", F.struct("start", "kind", place.alias("t"), kind.alias("class")).alias("s"))
    count = lambda c: F.count(F.when(c, 1))
    in_order = lambda part: F.array_join(F.transform(F.array_sort(F.collect_list("s")), part), ",")
    per_row = rated.groupBy("_row").agg(
        *[count(F.col("kind") == i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        *[count(F.col("class") == c).alias(f"n_{c}") for c in ("copied", "live", "placeholder")],
        F.max("n_owners").alias("max_owners"),
        F.max("n_repositories").alias("max_repositories"),
        in_order(lambda x: x["t"]).alias("spans"),
        in_order(lambda x: F.concat_ws(":", x["t"], x["class"])).alias("classes"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    spans = F.coalesce("spans", F.lit(""))
    return found.select("_row", "_id").join(per_row, "_row", "left").select(
        F.col("_id").alias(id_col),
        *[zero(f"n_{k}") for k in KINDS],
        F.sha2(spans, 256).alias("base_sha256"),
        spans.alias("spans"),
        *[zero(c) for c in ("n_copied", "n_live", "n_placeholder", "max_owners", "max_repositories")],
        F.coalesce("classes", F.lit("")).alias("classes"),
    )

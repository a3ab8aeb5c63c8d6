"""Line dedup by a tree of log templates: lines that recur across documents are dropped after their first document.

The tree has a fixed depth: the number of tokens, then the leading tokens. Tokens with a digit are variable fields from
the start. A leaf may hold any number of templates. For each of a line's positions, the leaf's different lines with the
same token there are counted, each as often as documents have it. The line's level is the count that its commonest
`similar` of positions reach: the lines of one template have at least those positions in common, so the level tells how
large the template is. A position whose count is below `constant` of the level is a variable field. Where the level is
under `min_docs`, nothing is generalised and the line stands for itself. A template found in `min_docs` documents or more
recurs. It stays in the document of the smallest doc_id and goes from all others. Lines of fewer than `min_tokens` tokens
are in no leaf and always stay.

Only DataFrame operations: lines meet by two hashes, of their leaves and of their tokens, in counts that are combined
before they move; the texts of lines move only for leaves with enough lines, and whole texts once, to meet the numbers of
their dropped lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut
from .components import apart
from .rules import let, words_of

FIELD = "<*>"
#: Lines (of some 50 bytes each) that are looked up by sending them to all tasks; for more, the texts move to them.
FEW = 100_000


def tokens_of(line: Column) -> Column:
    """The tokens of a line, those with a digit as a variable field."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, "[^ \\t-\\r]*[0-9][^ \\t-\\r]*", FIELD)).otherwise(line)
    return words_of(masked)


def lines_of(docs: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    """doc_id, line_no, leaf and own (a hash of all tokens) of each line of at least min_tokens."""
    lines = docs.where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    told = let(tokens_of(F.col("line")), lambda t: F.struct(F.size(t).alias("size"), F.xxhash64(F.size(t), F.slice(t, 1, depth)).alias("leaf"), F.xxhash64(t).alias("own")))
    return lines.select("doc_id", "line_no", told.alias("x")).where(F.col("x.size") >= min_tokens).select("doc_id", "line_no", "x.leaf", "x.own")


def dropped(docs: DataFrame, min_docs: int = 3, min_tokens: int = 5, depth: int = 4, constant: float = 0.9, similar: float = 0.6) -> DataFrame:
    """doc_id and lost, the numbers (from 0) of its lines that recur in an earlier document; none for other documents."""
    lines = cut(lines_of(docs, depth, min_tokens))
    full = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("leaf")
    some = cut(lines.join(apart(full, "leaf"), "leaf"))
    own = some.groupBy("leaf", "own", "doc_id").agg(F.min("line_no").alias("line_no"))
    own = cut(own.groupBy("leaf", "own").agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("doc_id", "line_no")).alias("at")))
    # A leaf with one template only has nothing to generalise; for the others, one line of each template is looked up.
    mixed = own.groupBy("leaf").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("leaf")
    wanted = cut(own.join(apart(mixed, "leaf"), "leaf").select(F.col("at.doc_id").alias("doc_id"), F.struct(F.col("at.line_no").alias("line_no"), "leaf", "own", "docs").alias("x")))
    few = wanted.count() <= FEW
    wanted = wanted.groupBy("doc_id").agg(F.collect_list("x").alias("xs"))
    # Rows that share a doc_id may differ in text: the hash tells which one was meant.
    text = docs.select("doc_id", "text").join(F.broadcast(wanted) if few else wanted, "doc_id").select(F.inline(let(F.split("text", "\n"), lambda s: F.transform("xs", lambda x: F.struct(x["leaf"].alias("leaf"), x["own"].alias("own"), x["docs"].alias("docs"), F.get(s, x["line_no"]).alias("line"))))))
    text = text.where("line IS NOT NULL").select("leaf", "own", "docs", tokens_of(F.col("line")).alias("tokens")).where(F.xxhash64("tokens") == F.col("own")).dropDuplicates(["leaf", "own"])
    at = cut(text.select("leaf", "own", "docs", F.posexplode("tokens").alias("pos", "token")))
    held = at.groupBy("leaf", "pos", "token").agg(F.sum("docs").alias("held"))
    lined = at.select("leaf", "own", "pos", "token").join(apart(held, "pos"), ["leaf", "pos", "token"]).groupBy("leaf", "own").agg(F.array_sort(F.collect_list(F.struct("pos", "token", "held"))).alias("x"))
    level = F.element_at(F.sort_array(F.transform("x", lambda t: t["held"]), asc=False), F.ceil(similar * F.size("x")).cast("int"))
    masked = F.transform("x", lambda t: F.when(t["held"] >= constant * F.col("level"), t["token"]).otherwise(FIELD))
    general = cut(lined.withColumn("level", level).where(F.col("level") >= min_docs).select("leaf", "own", F.xxhash64(masked).alias("template")))
    keyed = some.join(general, ["leaf", "own"], "left").select("doc_id", "line_no", "leaf", F.coalesce("template", "own").alias("key"))
    often = keyed.groupBy("leaf", "key", "doc_id").agg(F.count(F.lit(1)).alias("n")).groupBy("leaf", "key").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first")).where(F.col("docs") >= min_docs)
    gone = keyed.join(apart(often.select("leaf", "key", "first"), "key"), ["leaf", "key"]).where("doc_id > first")
    return gone.groupBy("doc_id").agg(F.collect_set("line_no").alias("lost"))


def clean(docs: DataFrame, into: tuple[str, str] = ("n_lines", "n_dropped"), **how) -> DataFrame:
    """docs with text less the dropped lines, and n_lines and n_dropped (or other names).

    A row for each of docs', other columns as they are. A null text or doc_id loses nothing. Rows that share a doc_id
    count as one document, and each loses the lines whose numbers are dropped. Columns of docs with the names of `into`
    are replaced, and no others.
    """
    here, of = "_".join(["lost", *docs.columns]), "_".join(["lost_of", *docs.columns])
    lost = dropped(docs, **how).select(F.col("doc_id").alias(of), F.col("lost").alias(here))
    out = docs.join(lost, F.col("doc_id") == F.col(of), "left").drop(of)
    lines, gone = F.split("text", "\n"), F.col(here)
    left = let(lines, lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), gone), lambda i: F.get(x, i)), "\n"))
    new = {"text": F.when(gone.isNull(), F.col("text")).otherwise(left), into[0]: F.coalesce(F.size(lines), F.lit(0)).cast("long"), into[1]: F.coalesce(F.size(gone), F.lit(0)).cast("long")}
    return out.withColumns(new).drop(here)

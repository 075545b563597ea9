"""Line de-duplication by a log-template tree, with DataFrame functions only.

Every line is parsed down a tree of fixed depth: first its number of tokens, then its leading tokens, then its last ones.
Tokens that carry digits, addresses or links are variable fields and are generalised on the way, as is everything between the
leading and the last tokens. Lines that end in the same leaf share a template.

A template that recurs in ``min_docs`` documents is dropped from all of them, where copies count as one document: choosing
one of several copies is the business of document de-duplication, so the lines of copied documents stay, and boilerplate goes.
A document whose other text mostly recurs is a copy; all copies with the same longest recurring line have one vote together, and
every other document has its own. A line of more than ``LONG`` tokens is dropped if it has two votes already, as it does not
recur by chance; such lines are compared whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.storage import stored

#: Depth of the tree below the token count: leading tokens, and tokens at the end of longer lines.
LEADING, LAST = 8, 4
#: A document is a copy, as seen from one of its lines, if more than this share (percent, by tokens) of its other text recurs.
COPIED_PERCENT = 60
#: A line of more tokens is a passage, which recurs from two documents on, if at most so many of its compared tokens are variable.
LONG, VARIABLE = 50, 4
#: Salt for joins on templates: a line of a third of all documents is spread over so many tasks.
SALTS = 16


def _generalised(tokens: Column) -> Column:
    """Lower case, with links, addresses and tokens that hold digits replaced by a mark."""
    # a match begins where a token does, so that other tokens are read once and not from each of their letters
    marked = F.regexp_replace(F.lower(tokens), r"(?<![^ ])[^ ]*?(?:[0-9@]|://)[^ ]*", "<*>")
    return F.when(tokens.rlike("[0-9@]|://"), marked).otherwise(F.lower(tokens))


def templates(documents: DataFrame, text: str = "text") -> DataFrame:
    """One row per non-blank line: ``doc_key``, ``line_no`` (from 0), ``n_tokens``, ``template`` (a 92-bit hash),
    ``passage`` (a long line with few variable fields).

    Lines of more than ``LONG`` tokens share a template only if they agree, generalised, from end to end.
    Fields are separated by spaces, tabs or carriage returns; lines by line feeds only.
    """
    lines = documents.select(
        _doc_key(documents, text).alias("doc_key"),
        F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"),
    ).select("doc_key", "line_no", F.trim(F.regexp_replace("line", r"[ \t\r]+", " ")).alias("line"))
    n = (F.length("line") - F.length(F.translate("line", " ", "")) + 1).alias("n_tokens")
    parsed = lines.where("line <> ''").select("doc_key", "line_no", "line", n)
    leaf = F.concat_ws(
        "\n",
        F.col("n_tokens").cast("string"),
        _generalised(F.substring_index("line", " ", LEADING)),
        F.when(F.col("n_tokens") > LEADING, _generalised(
            F.call_function("substring_index", F.col("line"), F.lit(" "), -F.least(F.lit(LAST), F.col("n_tokens") - LEADING)))),
    )
    passage = (F.col("n_tokens") > LONG) & (F.size(F.split(leaf, r"<\*>")) - 1 <= VARIABLE)
    leaf = F.concat_ws("\n", leaf, F.when(F.col("n_tokens") > LONG, _generalised(F.col("line"))))
    # ``a`` decides between lines of one length, so it is a digest that SQL has as well
    return parsed.select("doc_key", "line_no", "n_tokens", F.struct(
        F.conv(F.substring(F.md5(leaf), 1, 15), 16, 10).cast("long").alias("a"), F.hash(F.lit(7), leaf).alias("b")).alias("template"),
        passage.alias("passage"))


def _doc_key(documents: DataFrame, text: str) -> Column:
    """A key of the row's whole content, so that null or repeated ids and repeated rows do no harm."""
    ids = [F.col(f"`{c}`") for c in documents.columns if c == "doc_id"]
    return F.struct(F.xxhash64(*ids, F.col(text)).alias("a"), F.hash(F.lit(11), *ids, F.col(text)).alias("b"))


def _salted(small: DataFrame) -> DataFrame:
    return small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def boilerplate(lines: DataFrame, min_docs: int, copied_percent: int = COPIED_PERCENT) -> DataFrame:
    """The templates to drop. ``lines``: as :func:`templates` gives them."""
    per_doc = lines.groupBy("template", "doc_key").agg(F.sum("n_tokens").alias("tokens"), F.max("passage").alias("passage"))
    recurring = per_doc.groupBy("template").agg(F.count("*").alias("docs")).where("docs >= 2").select("template")
    salt = F.pmod(F.col("doc_key.a"), F.lit(SALTS)).cast("int").alias("salt")
    known = per_doc.select("*", salt).join(_salted(recurring), ["template", "salt"])
    share = known.groupBy("doc_key").agg(
        F.sum("tokens").alias("recurring_tokens"), F.max(F.struct("tokens", "template.a", "template.b")).alias("longest"))
    total = lines.groupBy("doc_key").agg(F.sum("n_tokens").alias("all_tokens"))
    rest, others = F.col("all_tokens") - F.col("tokens"), F.col("recurring_tokens") - F.col("tokens")
    # a document that is nothing but the line is a copy too
    copy = (others * 100 > rest * copied_percent) | (rest == 0)
    one = F.when(copy, F.struct("longest.a", "longest.b")).otherwise(F.col("doc_key"))
    votes = known.join(share.join(total, "doc_key"), "doc_key").select("template", "passage", copy.alias("copy"), one.alias("vote")).distinct()
    needed = F.when(F.col("passage"), F.least(F.lit(2), F.lit(min_docs))).otherwise(min_docs)
    return votes.groupBy("template").agg(F.count("*").alias("docs"), F.max("passage").alias("passage")).where(
        F.col("docs") >= needed).select("template")


def drop_recurring_lines(
    documents: DataFrame, text: str = "text", min_docs: int = 10, copied_percent: int = COPIED_PERCENT,
) -> DataFrame:
    """``documents`` with their boilerplate lines removed, and the columns ``n_lines`` and ``n_dropped``.

    A null text stays null and has no lines; an empty text stays empty. A document that loses all its lines keeps an empty
    text. Blank lines count as lines and are never dropped. Repeated rows are counted as one document and are all kept.
    Columns of the input that are called ``n_lines`` or ``n_dropped`` are replaced.
    """
    kept_columns = [c for c in documents.columns if c not in ("n_lines", "n_dropped")]
    documents = documents.select(*[F.col(f"`{c}`") for c in kept_columns])
    lines = stored(templates(documents, text), "lines")
    drops = boilerplate(lines, min_docs, copied_percent)
    salt = F.pmod(F.col("doc_key.a"), F.lit(SALTS)).cast("int").alias("salt")
    gone = (
        lines.select("doc_key", "line_no", "template", salt).join(_salted(drops), ["template", "salt"])
        .groupBy("doc_key").agg(F.collect_set("line_no").alias("gone"))
    )
    # the document's own columns stay in a struct, where their names can't clash
    joined = documents.select(F.struct(*[F.col(f"`{c}`") for c in kept_columns]).alias("doc"), _doc_key(documents, text).alias("doc_key"))
    joined = joined.join(gone, "doc_key", "left")
    whole = F.col(f"doc.`{text}`")
    parts = F.split(whole, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    # the outer transform binds the parts to a variable, so that they are split once and not for each kept line
    left = F.get(F.transform(F.array(parts), lambda p: F.transform(kept, lambda i: F.get(p, i))), F.lit(0))
    rest = F.when(F.col("gone").isNull(), whole).otherwise(F.array_join(left, "\n"))
    return joined.select(
        *[rest.alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in kept_columns],
        F.when(whole.isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )

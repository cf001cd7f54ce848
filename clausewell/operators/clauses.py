"""From the HTML of hierarchical documents to addressable clauses."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from clausewell.functions import markup

#: A non-leaf clause needs an introduction of so many characters to be kept.
PARENT_INTRO_MIN = 150
#: A table's caption is looked for in so many characters before it.
TABLE_LOOK_BACK = 800
#: Paragraphs around a figure's caption that may hold its image, in this order.
FIGURE_ORDER = (1, 2, 3, -1, -2, -3, 0)


def heading_blocks(docs: DataFrame, doc: str = "doc", html: str = "html") -> DataFrame:
    """(doc, idx, level, clause_no, title, body_html) of the numbered headings.

    A body reaches to the next heading of any kind; headings without a number emit
    nothing, so the text below them belongs to no block.
    """
    parts = F.split(F.col(html), r"(?is)(?=<h[1-6][^>]*>.*?</h[1-6]>)")
    block = docs.select(doc, F.posexplode(parts).alias("idx", "part"))
    pattern = r"(?is)^<h([1-6])[^>]*>(.*?)</h\1>"
    head = block.where(F.col("part").rlike(pattern)).select(
        doc, "idx",
        F.regexp_extract("part", pattern, 1).cast("int").alias("level"),
        markup.heading(markup.strip_tags(F.regexp_extract("part", pattern, 2))).alias("h"),
        F.regexp_replace("part", pattern, "").alias("body_html"),
    )
    return head.where("h is not null").select(doc, "idx", "level", "h.clause_no", "h.title", "body_html")


def leaf_clauses(blocks: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, idx, clause_no, title, parent_no, parent_title, text) of kept clauses.

    ``blocks`` has doc, idx, clause_no, title, text.  A block is a leaf unless the
    next one continues its number; others stay if their introduction is long enough.
    Of equal numbers the first row stays, while as a parent the last title counts.
    Rows before the first kept clause ``1`` are front matter and go.
    """
    order = Window.partitionBy(doc).orderBy("idx")
    following = F.lead("clause_no").over(order)
    leaf = ~F.coalesce(following.startswith(F.concat("clause_no", F.lit("."))), F.lit(False))
    kept = blocks.withColumn("leaf", leaf).where(F.col("leaf") | (F.length("text") >= PARENT_INTRO_MIN))
    first = kept.withColumn("rn", F.row_number().over(Window.partitionBy(doc, "clause_no").orderBy("idx"))).where("rn = 1")
    scope = F.coalesce(F.min(F.when(F.col("clause_no") == "1", F.col("idx"))).over(Window.partitionBy(doc)), F.lit(0))
    body = first.withColumn("from_idx", scope).where("idx >= from_idx").withColumn("parent_no", markup.parent_no(F.col("clause_no")))
    titles = blocks.groupBy(doc, F.col("clause_no").alias("parent_no")).agg(F.max_by("title", "idx").alias("parent_title"))
    return body.join(titles, [doc, "parent_no"], "left").select(doc, "idx", "clause_no", "title", "parent_no", "parent_title", "text")


def clause_paths(clauses: DataFrame, titles: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, clause_no, path): titles of the ancestors, outermost first, joined by
    `` / ``; ancestors without a title are skipped.  ``titles``: doc, clause_no, title."""
    parts = F.split("clause_no", r"\.")
    depth = F.size(parts)
    ancestors = F.when(depth > 1, F.transform(F.sequence(F.lit(1), depth - 1), lambda n: F.array_join(F.slice(parts, 1, n), "."))).otherwise(F.array().cast("array<string>"))
    steps = clauses.select(doc, "clause_no", F.posexplode_outer(ancestors).alias("depth", "ancestor"))
    named = steps.join(titles.select(F.col(doc), F.col("clause_no").alias("ancestor"), F.col("title")), [doc, "ancestor"], "left")
    ordered = F.array_sort(F.collect_list(F.when(F.col("title").isNotNull(), F.struct("depth", "title"))))
    return named.groupBy(doc, "clause_no").agg(F.array_join(F.transform(ordered, lambda s: s["title"]), " / ").alias("path"))


def tables(clauses: DataFrame, key: str = "id", html: str = "html") -> DataFrame:
    """(id, no, caption_no, caption, rows) of each table that has a cell; no counts
    all tables, caption_no is null without a caption of its own."""
    parts = F.split(F.col(html), r"(?i)(?=<table\b)")
    # Each part takes along the end of what stands before it, not all of it.
    start = F.struct(F.lit("").alias("tail"), F.array().cast("array<struct<part:string,before:string>>").alias("out"))
    step = lambda acc, p: F.struct(F.right(F.concat(acc["tail"], p), F.lit(TABLE_LOOK_BACK)).alias("tail"), F.concat(acc["out"], F.array(F.struct(p.alias("part"), acc["tail"].alias("before")))).alias("out"))
    texts = clauses.select(key, F.posexplode(F.aggregate(parts, start, step, lambda acc: acc["out"])).alias("no", "t"))
    texts = texts.where("t.part rlike '(?i)^<table\\\\b'")
    inner = F.regexp_extract("t.part", r"(?is)^<table\b[^>]*>(.*?)</table>", 1)
    cells = lambda tr: F.transform(F.regexp_extract_all(tr, F.lit(r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]>"), F.lit(1)), markup.strip_tags)
    rows = F.filter(F.transform(F.regexp_extract_all(inner, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1)), cells), lambda r: F.size(r) > 0)
    last = F.try_element_at(F.regexp_extract_all("t.before", F.lit(r"(?is)<p[^>]*>(.*?)</p>"), F.lit(1)), F.lit(-1))
    caption = markup.strip_tags(F.coalesce(last, F.lit("")))
    pattern = r"^Table\s+([\dA-Z][\d.A-Z-]*):?\s*(.+?)\z"
    no = F.dense_rank().over(Window.partitionBy(key).orderBy("no"))
    found = texts.select(key, no.cast("bigint").alias("no"), F.nullif(F.regexp_extract(caption, pattern, 1), F.lit("")).alias("caption_no"), F.trim(F.regexp_extract(caption, pattern, 2)).alias("caption"), rows.alias("rows"))
    return found.where(F.size("rows") > 0)


_PARAGRAPH = re.compile(r"<p[^>]*>(.*?)</p>", re.IGNORECASE | re.DOTALL)
_IMAGE = re.compile(r"""<img\b[^>]*data-media-filename=["']([^"']+)["']""", re.IGNORECASE)
_CAPTION = re.compile(r"^Figure\s+([0-9A-Z][0-9.A-Z-]*):?\s*(.+)$", re.DOTALL)


def pair_figures(html: str) -> list[tuple[str, str, str | None]]:
    """(number, caption, image) of the figures of a clause; an image belongs to the
    first caption that finds it among the paragraphs around."""
    seen: set[str] = set()
    inner = _PARAGRAPH.findall(html)
    images = [_IMAGE.findall(p) for p in inner]
    texts = [" ".join(re.sub(r"<[^>]+>", " ", p).split()) for p in inner]
    out = []
    for i, text in enumerate(texts):
        m = _CAPTION.match(text)
        if m:
            around = (name for d in FIGURE_ORDER if 0 <= i + d < len(inner) for name in images[i + d] if name not in seen)
            image = next(around, None)
            if image:
                seen.add(image)
            out.append((m[1], m[2].strip(), image))
    return out


def figures(clauses: DataFrame, key: str = "id", html: str = "html") -> DataFrame:
    """(id, figure_no, caption, image): the pairing is sequential within a clause, so
    it runs in Arrow batches, clause by clause."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, *f) for k, h in zip(pdf[key], pdf[html], strict=True) for f in pair_figures(h or "")]
            yield pd.DataFrame(rows, columns=[key, "figure_no", "caption", "image"])

    kind = clauses.schema[key].dataType.simpleString()
    return clauses.select(key, html).mapInPandas(run, f"{key} {kind}, figure_no string, caption string, image string")


def parse_report(clauses: DataFrame, by: str, measures: dict[str, Column]) -> DataFrame:
    """Counts and sums by document, and a row of totals (null)."""
    return clauses.rollup(by).agg(F.count("*").alias("clause_count"), *[F.sum(c).alias(n) for n, c in measures.items()])


#: Images that stand in a page as data: media type, content.
INLINE_IMAGE = r"""(?i)<img\b[^>]*?src=["']data:([^;"']+);base64,([^"']*)["'][^>]*>"""


def numbered_images(parts: DataFrame, doc: str, part: str, html: str) -> DataFrame:
    """(doc, part, html, images): images that stand in the pages as data are named
    ``<doc>-image-<n>.<extension>``, counted on from part to part, and referred to by name.
    One of an unknown type takes a number, but has no name and is not among ``images``
    (name, mime, data).

    Only the counts of parts, a small row each, are put in order to count on.
    """
    types = F.regexp_extract_all(html, F.lit(INLINE_IMAGE), F.lit(1))
    rows = parts.select(doc, part, html, types.alias("_types"))
    order = Window.partitionBy(doc).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy(doc, part).agg(F.max(F.size("_types")).alias("_n")).select(doc, part, F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before"))
    rows = rows.join(before, [doc, part])
    name = lambda t, i: F.when(markup.extension_of(t) == "bin", F.lit("")).otherwise(F.concat(F.col(doc).cast("string"), F.lit("-image-"), (F.col("_before") + i + 1).cast("string"), F.lit("."), markup.extension_of(t)))
    rows = rows.withColumn("_names", F.transform("_types", name))
    tag = lambda n: F.when(n == "", F.lit('<img src="" data-media-filename="">')).otherwise(F.concat(F.lit('<img src="media:'), n, F.lit('" data-media-filename="'), n, F.lit('" alt="'), n, F.lit('">')))
    pieces = F.transform(F.split(html, INLINE_IMAGE), lambda p, i: F.concat(p, F.coalesce(tag(F.get("_names", i)), F.lit(""))))
    data = F.regexp_extract_all(html, F.lit(INLINE_IMAGE), F.lit(2))
    images = F.filter(F.transform(F.arrays_zip("_names", "_types", data.alias("_data")), lambda x: F.struct(x["_names"].alias("name"), x["_types"].alias("mime"), x["_data"].alias("data"))), lambda x: x["name"] != "")
    return rows.select(doc, part, F.array_join(pieces, "").alias(html), images.alias("images"))


def joined_parts(parts: DataFrame, doc: str, part: str, html: str, warnings: str | None = None, most: int = 5) -> DataFrame:
    """(doc, html, warnings): the parts of each document in their order as one page, with
    the first ``most`` of their warnings (array column ``warnings``, without one: none)."""
    none = F.array().cast("array<string>")
    said = F.coalesce(F.slice(F.col(warnings), 1, most), none) if warnings else none
    ordered = F.array_sort(F.collect_list(F.struct(F.col(part).alias("part"), F.coalesce(F.col(html), F.lit("")).alias("html"), said.alias("said"))))
    whole = parts.groupBy(doc).agg(ordered.alias("_parts"))
    return whole.select(doc, F.array_join(F.transform("_parts", lambda p: p["html"]), "\n").alias(html), F.slice(F.flatten(F.transform("_parts", lambda p: p["said"])), 1, most).alias("warnings"))


def orphans(files: DataFrame, used: DataFrame, name: str) -> DataFrame:
    """Files that nothing refers to: none of ``used`` has their name."""
    return files.join(used.select(name).where(F.col(name).isNotNull()), name, "left_anti")


def media_counts(pages: DataFrame, files: DataFrame, key: str, file: str, size: Column) -> DataFrame:
    """(key, figures, missing, bytes): of each page the files that there are, whether it
    lacks any (1 or 0), and their size; ``files`` holds key and file."""
    joined = pages.select(key).join(files.select(key, F.col(file).alias("_file"), size.alias("_size")), key, "left")
    missing = F.sum(F.when(F.col("_file").isNull(), 1).otherwise(0))
    return joined.groupBy(key).agg(F.count("_file").alias("figures"), missing.alias("missing"), F.coalesce(F.sum("_size"), F.lit(0)).alias("bytes"))


#: A text of fewer characters is suspiciously short.
SHORT_TEXT = 30


def quality_flags(clauses: DataFrame, key: str, title: Column, text: Column) -> DataFrame:
    """(key, short_text, no_title): what a build warns of; null reads as empty."""
    return clauses.select(key, (F.length(F.coalesce(text, F.lit(""))) < SHORT_TEXT).alias("short_text"), (F.trim(F.coalesce(title, F.lit(""))) == "").alias("no_title"))

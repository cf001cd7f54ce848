"""HTML, identifiers and other small notations as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The six entities that are decoded, in this order.
ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")]
# Tags that become layout.
LAYOUT = [(r"(?i)<br\s*/?>", "\n"), (r"(?i)</p>", "\n\n"), (r"(?i)</li>", "\n"), (r"(?i)<li[^>]*>", "  - "), (r"(?i)</tr>", "\n"), (r"(?i)<td[^>]*>", " | "), (r"(?i)<th[^>]*>", " | ")]
# Media types, their extension on disk, and back (others: octets).
EXTENSION_OF = {"image/png": "png", "image/jpeg": "jpeg", "image/jpg": "jpeg", "image/gif": "gif", "image/webp": "webp", "image/svg+xml": "svg", "image/x-wmf": "wmf", "image/wmf": "wmf", "image/x-emf": "emf", "image/emf": "emf"}
MIME_OF = {"png": "image/png", "jpeg": "image/jpeg", "jpg": "image/jpeg", "gif": "image/gif", "webp": "image/webp", "svg": "image/svg+xml"}
#: White space with the no-break and other Unicode spaces.
SPACES = r"(?U)\s"


def collapse(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, SPACES + "+", " "), r"^ | \z", "")


def decode_entities(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES, text)


def strip_tags(html: Column) -> Column:
    """A fragment's text: tags are spaces, white space is collapsed."""
    return collapse(decode_entities(F.regexp_replace(html, r"<[^>]+>", " ")))


def html_to_text(html: Column) -> Column:
    """A page's text with its paragraphs, list items and table cells laid out and
    the word processor's field codes removed."""
    text = reduce(lambda t, r: F.regexp_replace(t, *r), LAYOUT, html)
    text = decode_entities(F.regexp_replace(text, r"<[^>]+>", ""))
    text = F.regexp_replace(text, r"(?<![A-Za-z0-9_])(PAGEREF|STYLEREF|HYPERLINK|MERGEFORMAT|Toc\d+)(?![A-Za-z0-9_])[^\n]*", "")
    text = F.array_join(F.transform(F.split(text, "\n"), collapse), "\n")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    return F.regexp_replace(text, r"^\n+|\n+\z", "")


def heading(raw: Column) -> Column:
    """struct(clause_no, title) of a numbered heading, else null.

    Refused: lines of a table of contents, titles of over 200 characters and whole
    numbers of ten or more.
    """
    text = F.regexp_replace(raw, rf"^{SPACES}+|{SPACES}+\z", "")
    pattern = r"^([A-Z]?\d+(?:\.\d+)*|[A-Z](?:\.\d+)+)(?U:\s)+(.+?)(?U:\s)*\z"
    no, title = F.regexp_extract(text, pattern, 1), collapse(F.regexp_extract(text, pattern, 2))
    fine = (no != "") & ~text.rlike(r"\.\.\.\s*\d+\s*\z") & (F.length(title) <= 200) & ~no.rlike(r"^[1-9]\d+\z|^0+[1-9]\d+\z")
    return F.when(fine, F.struct(no.alias("clause_no"), title.alias("title")))


def decode_version(tag: Column) -> Column:
    """A three-character base-36 tag as a dotted version; other tags unchanged."""
    parts = [F.conv(F.substring(tag, i, 1), 36, 10) for i in (1, 2, 3)]
    return F.when(tag.rlike(r"^[0-9a-z]{3}\z"), F.concat_ws(".", *parts)).otherwise(tag)


def spec_stem(spec: Column) -> Column:
    """The document number without its first dot."""
    return F.regexp_replace(spec, r"^([^.]*)\.", "$1")


def parent_no(clause_no: Column) -> Column:
    """All but the last dotted part; null at the top."""
    return F.when(F.contains(clause_no, F.lit(".")), F.regexp_replace(clause_no, r"\.[^.]+\z", ""))


def spec_of(clause_id: Column) -> Column:
    return F.split_part(clause_id, F.lit("#"), F.lit(1))


def chapter_of(clause_id: Column) -> Column:
    return F.split_part(F.split_part(clause_id, F.lit("#"), F.lit(2)), F.lit("."), F.lit(1))


IDENTIFIER = r"(?<![A-Za-z0-9_])[A-Za-z][A-Za-z0-9]*(?:-[A-Za-z0-9]+)+(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])[a-z]+(?:[A-Z][a-z0-9]+)+(?![A-Za-z0-9_])"


def identifiers(text: Column) -> Column:
    """Hyphenated and camel-case identifiers, each once, in order."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({IDENTIFIER})"), F.lit(1)))


#: Where an identifier's words end.
WORD_ENDS = r"-|(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Za-z])(?=[0-9])"


def identifier_words(identifier: Column) -> Column:
    """An identifier's words of two characters or more."""
    return F.filter(F.split(identifier, WORD_ENDS), lambda w: F.length(w) >= 2)


def _lookup(key: Column, table: dict[str, str], default: str) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, key), F.lit(default))


def extension_of(mime: Column) -> Column:
    return _lookup(F.lower(F.trim(mime)), EXTENSION_OF, "bin")


def mime_of(name: Column) -> Column:
    """Media type from a file name's extension."""
    return _lookup(F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)\z", 1)), MIME_OF, "application/octet-stream")


def sanitize_svg(svg: Column) -> Column:
    """References to local files removed."""
    text = F.regexp_replace(svg, r"url\(['\"]?file://[^'\")]+['\"]?\)", "url(#none)")
    return F.regexp_replace(text, r"href=['\"]file://[^'\"]+['\"]", 'href=""')


def fnv1a(text: Column) -> Column:
    """32-bit FNV-1a over the code points."""
    start, prime, space = 2166136261, 16777619, 1 << 32
    points = F.filter(F.split(text, ""), lambda c: c != "")
    step = lambda x, c: F.pmod(x.bitwiseXOR(F.ascii(c).cast("long")) * F.lit(prime), F.lit(space))
    return F.aggregate(points, F.lit(start).cast("long"), step)


def magic_kind(hex_head: Column) -> Column:
    """Container kind from the first bytes in hex."""
    head = F.upper(hex_head)
    return F.when(head.startswith("D0CF11E0A1B11AE1"), "ole2").when(head.startswith("504B0304"), "zip").otherwise("other")


def part_name(file: Column, part_no: Column) -> Column:
    """A part's suffix from its file name (``..._s05.docx`` -> ``s05``), else part<i>."""
    suffix = F.regexp_extract(file, r"(?i)_([a-z0-9]+(?:-[a-z0-9]+)?)\.docx?\z", 1)
    return F.coalesce(F.nullif(F.lower(suffix), F.lit("")), F.concat(F.lit("part"), part_no.cast("string")))


def drawn_as_svg(name: Column) -> Column:
    """A vector image's name after conversion."""
    return F.regexp_replace(name, r"(?i)\.(wmf|emf)\z", ".svg")


def image_names(html: Column, spec: Column) -> Column:
    """Names for a page's images in order: ``<spec>-image-<n>.<ext>`` by media type."""
    types = F.regexp_extract_all(html, F.lit(r"""(?i)<img\b[^>]*src=["']data:([^;"']+);"""), F.lit(1))
    return F.transform(types, lambda t, i: F.concat(spec, F.lit("-image-"), (i + 1).cast("string"), F.lit("."), extension_of(t)))


def snippet(text: Column, term: Column, around: int = 40) -> Column:
    """Text around the first occurrence of a lower-case term; null without one."""
    at = F.instr(F.lower(text), term)
    start = F.greatest(F.lit(1), at - around)
    return F.when(at > 0, F.substring(text, start, at - start + F.length(term) + around))

import pytest
from pyspark.sql import functions as F

from clausewell.functions import markup, words
from clausewell.operators import chunking, clauses as C, enrich


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("1 Scope", ("1", "Scope")),
        (" A.1  x  y ", ("A.1", "x y")),
        ("\u00a05.2.1\u00a0Deep  title\n", ("5.2.1", "Deep title")),
        ("Annex A", None),
        ("788 MHz", None),
        ("9 MHz", ("9", "MHz")),
        ("9.2.5A x", None),
        ("1 Scope...... 7", None),
        ("1 " + "x" * 200, ("1", "x" * 200)),
        ("1 " + "x" * 201, None),
        ("", None),
        ("A5 t", ("A5", "t")),
        ("Scope", None),
    ],
)
def test_headings(spark, raw, want):
    got = one(spark, markup.heading(F.col("t")), t=raw)
    assert (tuple(got) if got else None) == want


def test_html_to_text(spark):
    html = "<p>a &amp;lt; b</p><ul><li>one</li><li>two</li></ul>x<br/>y<p>see PAGEREF _Toc12 \\h</p>\n\n\n\n<tr><td>c</td><th>d</th></tr>&nbsp;&#39;"
    assert one(spark, markup.html_to_text(F.col("t")), t=html) == "a < b\n\n- one\n- two\nx\nysee\n\n| c | d\n'"
    assert one(spark, markup.strip_tags(F.col("t")), t="<b>a</b>\u00a0 <i>b</i>&amp;amp;") == "a b &amp;"


def test_small_notations(spark):
    assert one(spark, markup.decode_version(F.col("t")), t="h70") == "17.7.0"
    assert one(spark, markup.decode_version(F.col("t")), t="H70") == "H70"
    assert one(spark, markup.spec_stem(F.col("t")), t="38.101-1.2") == "38101-1.2"
    assert one(spark, markup.parent_no(F.col("t")), t="5.3.1") == "5.3" and one(spark, markup.parent_no(F.col("t")), t="5") is None
    assert one(spark, markup.identifiers(F.col("t")), t="a supportedSRS-Resources b maxNrofCells maxNrofCells plain") == ["supportedSRS-Resources", "maxNrofCells"]
    assert one(spark, markup.fnv1a(F.col("t")), t="a") == 3826002220
    assert one(spark, markup.mime_of(F.col("t")), t="x.JPG") == "image/jpeg" and one(spark, markup.extension_of(F.col("t")), t=" Image/WMF") == "wmf"
    assert one(spark, markup.sanitize_svg(F.col("t")), t="<a href='file:///x'/>") == '<a href=""/>'


@pytest.mark.parametrize(
    ("word", "want"),
    [("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("vietnamization", "vietnam"), ("triplicate", "triplic"), ("hopefulness", "hope"), ("revival", "reviv"), ("adoption", "adopt"), ("probate", "probat"), ("cease", "ceas"), ("controller", "control"), ("roll", "roll"), ("oscillators", "oscil"), ("generalizations", "gener")],
)
def test_porter_stems(word, want):
    assert words.stem(word) == want


def test_tokens(spark):
    assert one(spark, words.tokens(F.col("t")), t="The CSI-RS of a\tcell_id, naïve x 5G") == ["csi-rs", "cell_id", "na", "ve", "5g"]
    assert one(spark, words.coverage(F.col("a"), F.col("b")), a="what beams fail", b="BEAMS recover") == 0.5
    assert one(spark, words.coverage(F.col("a"), F.col("b")), a="what", b="x") == 0.0


@pytest.mark.parametrize("body", ["", "x" * 1593, "x" * 1594, "x" * 5000, ("y" * 99 + "\n") * 60, ("z" * 50 + ". ") * 90, "a" * 1592 + "\n" + "b" * 900])
def test_chunk_windows_cover_the_text(body):
    label = "title\n"
    out = chunking.windows(label, body)
    assert all(c.startswith(label) and len(c) <= 1601 for c in out)
    rest = [c[len(label) :] for c in out]
    text = rest[0]
    for part in rest[1:]:
        k = next(k for k in range(min(len(part), 200), -1, -1) if text.endswith(part[:k]) and body.startswith(text + part[k:]))
        text += part[k:]
    assert text == body


def test_figures_are_paired_once():
    page = "<p>Figure 1: a</p><p><img data-media-filename='x.png'/></p><p>Figure 2: b</p><p>t</p><p>t</p><p>t</p><p>t</p><p><img data-media-filename='y.png'/>Figure A.3-1 c</p>"
    assert C.pair_figures(page) == [("1", "a", "x.png"), ("2", "b", None), ("A.3-1", "c", "y.png")]


def test_tables_with_and_without_captions(spark):
    far = "<p>Table 9: far</p>" + "x" * 800
    html = f"<p>Table 5-1: near</p><table><tr><th>h</th></tr><tr><td>1</td><td>a <b>b</b></td></tr></table><table></table>{far}<table><tr><td>z</td></tr></table>"
    rows = C.tables(spark.createDataFrame([("c", html)], "id string, html string")).orderBy("no").collect()
    assert [(r["no"], r["caption_no"], r["caption"], r["rows"]) for r in rows] == [(1, "5-1", "near", [["h"], ["1", "a b"]]), (3, None, "", [["z"]])]


def test_blocks_under_unnumbered_headings_vanish(spark):
    html = "<p>front</p><h1>1 Scope</h1><p>in</p><h2>History</h2><p>lost</p><H2 class='q'>1.1 <b>Next</b></H2>tail"
    rows = C.heading_blocks(spark.createDataFrame([("d", html)], "doc string, html string")).orderBy("idx").collect()
    assert [(r["level"], r["clause_no"], r["title"], r["body_html"]) for r in rows] == [(1, "1", "Scope", "<p>in</p>"), (2, "1.1", "Next", "tail")]


def test_leaves_introductions_front_matter_and_repeats(spark):
    blocks = [(0, "0.9", "pre", "x"), (1, "1", "Scope", "s"), (2, "2", "Short parent", "x" * 149), (3, "2.1", "leaf", "l"), (4, "3", "Long parent", "x" * 150), (5, "3.1", "first", "f"), (6, "3.1", "again", "g"), (7, "3", "Renamed", "r"), (8, "3.2", "kid", "k")]
    rows = C.leaf_clauses(spark.createDataFrame([("d", *b) for b in blocks], "doc string, idx int, clause_no string, title string, text string")).orderBy("idx").collect()
    assert [(r["idx"], r["clause_no"], r["parent_title"]) for r in rows] == [(1, "1", None), (3, "2.1", "Short parent"), (4, "3", None), (5, "3.1", "Renamed"), (8, "3.2", "Renamed")]


def test_aux_is_capped_after_the_entry_that_exceeds(spark):
    entries = ["a" * 3000, "b" * 3000, "c"]
    got = spark.createDataFrame([(entries,)], "e array<string>").select(enrich.capped(F.col("e")).alias("x")).first()["x"]
    assert [e[0] for e in got] == ["a", "b"]
    glossary = spark.createDataFrame([(2, "CA", "Carrier Aggregation"), (1, "BWP", "Bandwidth Part")], "no int, acronym string, expansion string")
    rows = spark.createDataFrame([("i", "BWP", "uses CA and twoWords; bandwidth part"), ("j", None, "plain")], "id string, title string, text string")
    got = {r["id"]: r["aux"] for r in enrich.clause_aux(rows, glossary).collect()}
    assert got == {"i": "two Words · Carrier Aggregation", "j": ""}


def test_images_are_numbered_over_parts(spark):
    from clausewell.operators import clauses as C

    image = lambda mime: f"<IMG alt='y' src=\"data:{mime};base64,QQ==\">"
    rows = [("s", 2, f"c{image('image/emf')}"), ("s", 1, f"a{image('image/png')}{image('x/y')}b"), ("s", 3, None), ("s", 4, f"{image('image/gif')}"), ("t", 1, "none <img src='u.png'>")]
    parts = spark.createDataFrame(rows, "spec string, part int, html string")
    named = C.numbered_images(parts, "spec", "part", "html")
    tag = lambda n: f'<img src="media:{n}" data-media-filename="{n}" alt="{n}">'
    got = {(r["spec"], r["part"]): (r["html"], [tuple(i) for i in r["images"] or []]) for r in named.collect()}
    assert got["s", 1] == ("a" + tag("s-image-1.png") + '<img src="" data-media-filename="">b', [("s-image-1.png", "image/png", "QQ==")])
    assert got["s", 2] == ("c" + tag("s-image-3.emf"), [("s-image-3.emf", "image/emf", "QQ==")])
    assert got["s", 4][1] == [("s-image-4.gif", "image/gif", "QQ==")] and got["t", 1] == ("none <img src='u.png'>", []) and got["s", 3][1] == []
    said = spark.createDataFrame([("s", i, f"p{i}", [f"w{i}", f"v{i}"] if i else None) for i in range(5)], "spec string, part int, html string, said array<string>")
    whole = C.joined_parts(said, "spec", "part", "html", "said").first()
    assert (whole["html"], whole["warnings"]) == ("p0\np1\np2\np3\np4", ["w1", "v1", "w2", "v2", "w3"])


def test_tokens_cut_from_bytes_are_those_of_the_expression(spark):
    import random

    import pyarrow as pa

    rng = random.Random(5)
    texts = ["", None, "The a-b_c X1 of İstanbul 20K ", "straße-ÄB cd", "ab", "-", "x", "İ", "ends withAB", "CD starts", "日本 ab日cd", *("".join(rng.choices("abTHEof -_.\nÄ日K0Iİé9", k=rng.randrange(40))) for _ in range(400))]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", words.tokens(F.coalesce("t", F.lit(""))).alias("k")).orderBy("i").collect()
    for part in (pa.array(texts), pa.array(["zz", *texts]).slice(1)):
        assert words.token_lists(part).to_pylist() == [r["k"] for r in rows]
    cut = list(words.slices(pa.record_batch({"i": list(range(len(texts))), "t": texts}), 100))
    assert len(cut) > 5 and [x for b in cut for x in b.column(1).to_pylist()] == texts


def test_entries_cut_from_bytes_are_those_of_the_expression(spark):
    import random

    import pyarrow as pa

    rng = random.Random(6)
    texts = ["", "searchSpace and csi-RS-Report2x, csi-RS-Report2x _a-b a-b_ x-- -y-z aB1Cd éa-bé pdcch-Config", *("".join(rng.choices(["ab", "cd", "Bc", "X", "X1", "a2", "-", "-", "_", " ", ".", "é", "\n"], k=rng.randrange(30))) for _ in range(600))]
    pairs = F.transform(markup.identifiers(F.col("t")), markup.identifier_words)
    plain = F.transform(F.filter(pairs, lambda w: F.size(w) >= 2), lambda w: F.array_join(w, " "))
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", plain.alias("k"), enrich.split_entries(F.col("t")).alias("u")).orderBy("i").collect()
    assert sum(len(r["k"]) for r in rows) > 100 and [r["u"] for r in rows] == [r["k"] for r in rows]
    assert enrich.entry_lists(pa.array(["zz-yy", *texts]).slice(1)).to_pylist() == [r["k"] for r in rows]

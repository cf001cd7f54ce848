"""DuckDB SQL of the queries that SQL can express on whole tables: archives, url filters
and manifests.  The others hash, tokenise or model texts in ways SQL has no functions for."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

WARC = """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to, true AS digest_ok FROM f"""


def _rest(url: str) -> str:
    return f"(CASE WHEN strpos({url}, '://') > 0 THEN substr({url}, strpos({url}, '://') + 3) ELSE '' END)"


def _lower(x: str) -> str:
    return f"translate({x}, '{_UPPER}', '{_LOWER}')"


def _host(url: str) -> str:
    return _lower(f"regexp_extract({_rest(url)}, '^([^/?#]*)', 1)")


def _path(url: str) -> str:
    return f"regexp_extract({_rest(url)}, '^[^/?#]*([^?#]*)', 1)"


def _no_dots(path: str) -> str:
    step = "CASE WHEN x = '.' THEN a WHEN x = '..' THEN regexp_replace(a, '/[^/]*$', '') ELSE a || '/' || x END"
    short = f"list_reduce(string_split({path}, '/'), lambda a, x: {step})"
    return f"(CASE WHEN {path} = '' THEN '/' WHEN contains({path}, '/.') THEN {short} || (CASE WHEN regexp_matches({path}, '/\\.\\.?$') THEN '/' ELSE '' END) ELSE {path} END)"


def _key(url: str) -> str:
    scheme = _lower(f"regexp_extract({url}, '^(.*?)://', 1)")
    query = f"regexp_extract({_rest(url)}, '^[^?#]*(\\?[^#]*)', 1)"
    host = f"CASE {scheme} WHEN 'http' THEN regexp_replace({_host(url)}, ':(80)?$', '') WHEN 'https' THEN regexp_replace({_host(url)}, ':(443)?$', '') ELSE {_host(url)} END"
    return f"(CASE WHEN {_host(url)} <> '' THEN {scheme} || '://' || ({host}) || {_no_dots(_path(url))} || {query} END)"


def _seen_from(link: str, url: str) -> str:
    """A link as an absolute url."""
    scheme = f"regexp_extract({url}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)"
    folder = f"regexp_extract({_path(url)}, '^(.*/)', 1)"
    root = f"{scheme} || '://' || {_host(url)}"
    return f"CASE WHEN regexp_matches({link}, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {link} WHEN regexp_matches({link}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN starts_with({link}, '//') THEN {scheme} || ':' || {link} WHEN starts_with({link}, '/') THEN {root} || {link} WHEN starts_with({link}, '?') THEN {root} || {_path(url)} || {link} ELSE {root} || (CASE WHEN {folder} = '' THEN '/' ELSE {folder} END) || {link} END"


def url_filter(rules: list[tuple[str, str, str]]) -> str:
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    fits = "(host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)"
    best = lambda rows, key: f"SELECT {key}, v, h || p AS rule FROM {rows} JOIN rules ON {fits} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY length(h || p) DESC, v) = 1"
    attribute = lambda tag, name: f"replace(regexp_extract(regexp_extract(html, '{tag}', 0), '{name}', 1), '&amp;', '&')"
    href = "(?i)[\\s\"'']href\\s*=\\s*[\"'']?\\s*([^\"''\\s>]+)"
    base = attribute("(?is)<base\\b[^>]*[\\s\"'']href\\s*=[^>]*>", href)
    canonical = attribute("(?is)<link\\b[^>]*[\\s\"'']rel\\s*=\\s*(\"([^\">]*\\s)?canonical[\\s\"]|''([^''>]*\\s)?canonical[\\s'']|canonical[\\s>/])[^>]*>?", href)
    refresh = attribute("(?is)<meta\\b[^>]*[\\s\"'']http-equiv\\s*=\\s*[\"'']?refresh\\b[^>]*>", "(?i)[\\s\"'']content\\s*=\\s*[\"'']?\\s*0+(\\.[0-9]*)?[\\s;,]\\s*url\\s*=\\s*[\"'']?\\s*([^\"''\\s>]+)").replace("', 1), '&amp;'", "', 2), '&amp;'")
    return f"""WITH RECURSIVE rules(v, h, p) AS (VALUES {values}),
rows_ AS (SELECT row_number() OVER () AS rid, page_id, coalesce({_host('url')}, '') AS host, coalesce({_path('url')}, '') AS path, {_key('url')} AS node FROM pages),
seen AS (SELECT url, regexp_replace(html, '(?is)<!--.*?(-->|\\z)|<script\\b.*?(</script|\\z)', '', 'g') AS html FROM pages),
found AS (SELECT url, {base} AS base, unnest([{canonical}, {refresh}]) AS link FROM seen),
based AS (SELECT url, coalesce(CASE WHEN base <> '' THEN {_seen_from('base', 'url')} END, url) AS base, link FROM found WHERE link <> ''),
targets AS (SELECT {_key('url')} AS src, {_seen_from('link', 'base')} AS to_url FROM based),
links AS (SELECT src, {_key('to_url')} AS dst FROM targets),
edges AS (SELECT src, dst FROM links WHERE src <> dst UNION SELECT dst, src FROM links WHERE src <> dst),
reach(a, b) AS (SELECT DISTINCT src, src FROM edges UNION SELECT a, dst FROM reach JOIN edges ON b = src),
ends AS (SELECT DISTINCT b, {_host('b')} AS host, {_path('b')} AS path FROM reach),
said AS ({best('ends', 'b')}),
blocked AS (SELECT DISTINCT a FROM reach JOIN said USING (b) WHERE v = 'block'),
own AS ({best('rows_', 'rid')})
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN a IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict FROM rows_ LEFT JOIN own USING (rid) LEFT JOIN blocked ON node = a"""


def _field(x: str) -> str:
    return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ['doc_id', 'source', 'lang', 'n_chars', text]))})"


#: CRC-32 of an id as text, bit by bit.
_CRC = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"


def _tree(at: str, leaves: str, levels: int) -> str:
    """Levels of the trees of ``leaves`` (tree, idx, h, n) as CTEs <at>0 to <at><levels>,
    whose runs are <at>r0 and on; a tree of one node stays as it is."""
    out = [f"{at}0 AS (SELECT tree, idx, h, n FROM {leaves})"]
    for k in range(levels):
        out.append(f"{at}r{k} AS (SELECT tree, idx // 3 AS up, n, list(h ORDER BY idx) AS hs FROM {at}{k} GROUP BY ALL)")
        out.append(f"{at}{k + 1} AS (SELECT tree, up AS idx, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h, (n + 2) // 3 AS n FROM {at}r{k})")
    return ",\n".join(out)


def _paths(at: str, start: str, tree: str, levels: int) -> str:
    """``start`` (no, tree, idx, fold, proof) led up the trees <tree>, as CTEs <at>0 to
    <at><levels>."""
    out = [f"{at}0 AS (SELECT no, tree, idx, fold, proof FROM {start})"]
    for k in range(levels):
        before, after = "list_slice(hs, 1, idx % 3)", "list_slice(hs, idx % 3 + 2, 3)"
        fold = f"CASE WHEN n = 1 THEN fold ELSE sha256(array_to_string({before}, '') || fold || array_to_string({after}, '')) END"
        proof = f"CASE WHEN n = 1 THEN proof ELSE proof || array_to_string({before}, '') || array_to_string({after}, '') END"
        out.append(f"{at}{k + 1} AS (SELECT no, p.tree, up AS idx, {fold} AS fold, {proof} AS proof FROM {at}{k} p JOIN {tree}r{k} r ON p.tree = r.tree AND p.idx // 3 = r.up)")
    return ",\n".join(out)


def merkle(levels: int = 12, top_levels: int = 6) -> str:
    """Trees of at most 3 ** levels leaves, 3 ** top_levels sources."""
    return f"""WITH d AS (SELECT row_number() OVER () AS no, doc_id, source, {_leaf('text')} AS leaf, CASE WHEN doc_id IS NOT NULL AND {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS fold FROM documents),
t AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS n FROM d GROUP BY source),
l AS (SELECT no, doc_id, leaf, fold, '' AS proof, leaf AS h, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
{_tree('a', 'l', levels)},
tops AS (SELECT 0 AS tree, tree AS idx, h, (SELECT count(*) FROM t) AS n FROM a{levels}),
{_tree('b', 'tops', top_levels)},
{_paths('p', 'l', 'a', levels)},
up AS (SELECT no, 0 AS tree, tree AS idx, fold, proof FROM p{levels}),
{_paths('q', 'up', 'b', top_levels)}
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(q.proof) AS proof_sha256, q.fold AS folded_root, q.fold = r.h AS verified
FROM l JOIN q{top_levels} q ON l.no = q.no JOIN a{levels} s ON l.tree = s.tree JOIN b{top_levels} r ON true"""

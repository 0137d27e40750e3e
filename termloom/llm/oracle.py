"""DuckDB SQL for the operators that SQL can state."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _crc32(digits: str) -> str:
    """Unsigned CRC-32 of a string of ASCII characters; the table follows from its polynomial."""
    table = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    codes = f"list_transform(string_split({digits}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    step = f"xor({table}[(xor(r, b) & 255) + 1], r >> 8)"
    return f"xor(list_reduce({codes}, lambda r, b: {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


def warc(min_revisit: int = 1000, chunk: int = 8192, segment: int = 1024) -> str:
    """Lengths, digests and revisits are those of the payloads; the number of segments follows
    from the length of a record's block: HTTP headers and, in a response, chunked framing."""
    revisit = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: \r\n\r\n"
    response = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    framed = f"n + (n // {chunk}) * {len(f'{chunk:x}') + 4} + CASE WHEN n % {chunk} > 0 THEN length(to_hex(n % {chunk})) + 4 ELSE 0 END + 5"
    return f"""WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
l AS (SELECT digest, max(page_id) AS last_page FROM p WHERE n >= {min_revisit} GROUP BY digest),
k AS (SELECT p.*, CASE WHEN page_id < last_page THEN last_page END AS refers_to FROM p LEFT JOIN l USING (digest))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to,
       CAST(greatest(1, ceil((CASE WHEN refers_to IS NULL THEN {len(response)} + {framed}
                              ELSE {len(revisit)} + length(CAST(n AS VARCHAR)) END) / {segment})) AS INTEGER) AS segments,
       CAST(NULL AS VARCHAR) AS problem FROM k"""


def simplex(k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, salt: str = "3:") -> str:
    """All rounds written out: means, then the nearest of them."""
    near = "list_sum(list_transform(list_zip(v.x, m.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [f"""v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
m0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS c, x FROM (
    SELECT sha256('{salt}' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM v) ORDER BY h, x LIMIT {k})"""]
    for i in range(rounds):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT w, any_value(x) AS x, arg_min(c, (d, c)) AS c FROM (
    SELECT v.w, v.x, m.c, {near} AS d FROM (SELECT row_number() OVER () AS w, x FROM v) v, m{i} m) GROUP BY w),
s{i} AS (
  SELECT c, i, CAST(sum(x[i]) AS HUGEINT) AS s, count(*) AS n FROM a{i}, (SELECT unnest(range(1, {width + 1})) AS i) GROUP BY c, i),
m{i + 1} AS MATERIALIZED (
  SELECT m.c, coalesce(n.x, m.x) AS x FROM m{i} m LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{i} GROUP BY c) n USING (c))""")
    return f"""WITH {', '.join(parts)},
near AS (
  SELECT any_value(vec_id) AS vec_id, min(d) AS distance, arg_min(c, (d, c)) AS cluster FROM (
    SELECT v.w, v.vec_id, m.c, {near} AS d FROM (SELECT row_number() OVER () AS w, * FROM v) v, m{rounds} m) GROUP BY w)
SELECT vec_id, cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.x, ',')) AS centroid_sha256
FROM near JOIN m{rounds} m ON m.c = near.cluster"""


def merkle(fan: int = 8, leaf_levels: int = 7, group_levels: int = 3) -> str:
    """Levels written out, enough for ``fan`` to their power of leaves of a language and of
    languages; a level with one node passes it on."""

    def field(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value} END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    def level(name: str, i: int) -> str:
        return f"""{name}r{i} AS MATERIALIZED (
  SELECT g, p // {fan} AS p, (n + {fan - 1}) // {fan} AS n, n > 1 AS folded, list(h ORDER BY p) AS hs
  FROM {name}{i} GROUP BY g, p // {fan}, n),
{name}{i + 1} AS MATERIALIZED (
  SELECT g, p, n, CASE WHEN folded THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {name}r{i})"""

    def climb(name: str, i: int, rows: str, out: str) -> str:
        left, right = f"array_to_string(r.hs[1:w.p % {fan}], '')", f"array_to_string(r.hs[w.p % {fan} + 2:], '')"
        return f"""{out} AS MATERIALIZED (
  SELECT w.* EXCLUDE (p, acc, proof), w.p // {fan} AS p,
         CASE WHEN folded THEN sha256({left} || acc || {right}) ELSE acc END AS acc,
         CASE WHEN folded THEN proof || {left} || {right} ELSE proof END AS proof
  FROM {rows} w JOIN {name}r{i} r ON r.g = w.g AND r.p = w.p // {fan})"""

    small = f"translate(text, '{UPPER}', '{LOWER}')"
    parts = [f"""f AS MATERIALIZED (
  SELECT doc_id, leaf, acc, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
         count(*) OVER (PARTITION BY g) AS n
  FROM (SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf('text')} AS leaf,
               CASE WHEN coalesce({_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0, false) THEN {leaf(small)} ELSE {leaf('text')} END AS acc FROM documents)),
a0 AS (SELECT g, p, n, leaf AS h FROM f)"""]
    parts += [level("a", i) for i in range(leaf_levels)]
    parts.append(f"""b0 AS MATERIALIZED (
  SELECT '' AS g, row_number() OVER (ORDER BY a.g) - 1 AS p, count(*) OVER () AS n, h, a.g AS lang FROM a{leaf_levels} a)""")
    parts += [level("b", i) for i in range(group_levels)]
    parts.append("w0 AS (SELECT doc_id, leaf, g, p, acc, '' AS proof FROM f)")
    parts += [climb("a", i, f"w{i}", f"w{i + 1}") for i in range(leaf_levels)]
    parts.append(f"""x0 AS (
  SELECT doc_id, leaf, b.h AS subroot, '' AS g, b.p, acc, proof FROM w{leaf_levels} w JOIN b0 b ON b.lang = w.g)""")
    parts += [climb("b", i, f"x{i}", f"x{i + 1}") for i in range(group_levels)]
    return f"""WITH {', '.join(parts)}
SELECT doc_id, leaf, subroot, b.h AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = b.h AS verified
FROM x{group_levels}, b{group_levels} b"""


def all_sql() -> dict[str, str]:
    return {"op1_warc": warc(), "op11_simplex": simplex(), "op13_merkle": merkle()}

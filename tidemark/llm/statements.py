"""DuckDB statements for the text queries that SQL can express."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _folded(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{UPPER}', '{UPPER.lower()}')"


# Plain patterns of personal data, in the order of the kinds.
_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}([A-Z0-9]{11,30}|(\x20[A-Z0-9]{4}){2,7}(\x20[0-9]{1,3})?)",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}


def _personal_data() -> str:
    hits = " UNION ALL ".join(
        f"""SELECT doc_id, {place} AS place, '{kind}' AS kind, regexp_extract_all(body, '{pattern}') AS m,
          string_split_regex(body, '{pattern}') AS g FROM docs"""
        for place, (kind, pattern) in enumerate(_PATTERNS.items())
    )

    def spans(condition: str) -> str:
        return f"""coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place)
          FILTER ({condition}), '')"""

    def count(kind: str) -> str:
        return f"count(*) FILTER (kind = '{kind}') AS n_{kind}"

    return f"""
      WITH docs AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
      hits AS ({hits}),
      each_hit AS (SELECT doc_id, place, kind, m, g, unnest(range(1, len(m) + 1)) AS i
        FROM hits WHERE len(m) > 0),
      placed AS (SELECT doc_id, place, kind, m[i] AS v,
          list_sum(list_transform(g[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start,
          regexp_replace(m[i], '[^0-9]', '', 'g') AS digits, right(g[i], 40) AS before, left(g[i + 1], 40) AS after
        FROM each_hit),
      marked AS (SELECT *, CAST(start AS BIGINT) + length(v) AS stop, length(digits) AS n,
          regexp_matches(right(before, 1), '[A-Za-z0-9]') OR regexp_matches(left(after, 1), '[A-Za-z0-9]') AS inside,
          regexp_matches(lower(before || ' ' || after), '(^|[^a-z])(ssn|social security|tax id)([^a-z]|$)') AS near
        FROM placed),
      checked AS (SELECT doc_id, place, kind, CAST(start AS BIGINT) AS start, stop FROM marked WHERE CASE kind
          WHEN 'email' THEN true
          WHEN 'ip' THEN len(list_filter(string_split(v, '.'),
            lambda x: length(ltrim(x, '0')) > 3 OR CAST('0' || right(x, 3) AS INTEGER) > 255)) = 0
          WHEN 'card' THEN n BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, n + 1), lambda j:
            CASE WHEN (n - j) % 2 = 0 THEN CAST(digits[j] AS INTEGER)
              ELSE (2 * CAST(digits[j] AS INTEGER)) // 10 + (2 * CAST(digits[j] AS INTEGER)) % 10 END)) % 10 = 0
          WHEN 'phone' THEN n BETWEEN 9 AND 15
          WHEN 'iban' THEN NOT inside AND list_reduce(list_transform(string_split(array_to_string(list_transform(
              string_split(substr(replace(v, ' ', ''), 5) || substr(v, 1, 4), ''),
              lambda c: CASE WHEN ord(c) >= 65 THEN CAST(ord(c) - 55 AS VARCHAR) ELSE c END), ''), ''),
            lambda d: CAST(d AS INTEGER)), lambda r, d: (r * 10 + d) % 97) = 1
          ELSE NOT inside AND near END),
      listed AS (SELECT doc_id, {", ".join(map(count, list(_PATTERNS)[:4]))},
          {spans("place < 4")} AS base, {spans("true")} AS spans
        FROM checked GROUP BY doc_id)
      SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in list(_PATTERNS)[:4])},
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
      FROM docs LEFT JOIN listed USING (doc_id)"""


# Vectors that take part in comparisons, in double precision.
_VECTORS = """SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0"""


def statements() -> dict[str, str]:
    return {
        # Lines within one edit agree before or behind the middle of what they have in common.
        "op3_line_dedup": """
          WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
          cut AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line,
            unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs WHERE text <> ''),
          placed AS (SELECT *, {'a': doc_id IS NULL, 'b': coalesce(doc_id, 0), 'c': pos} AS place FROM cut),
          firsts AS (SELECT line, min(place) AS first FROM placed WHERE length(line) >= 10 GROUP BY line),
          halved AS (SELECT line, first, r, line[1:r // 2] AS head, line[length(line) - (r - r // 2) + 1:] AS tail
            FROM (SELECT line, first, unnest([length(line), length(line) - 1]) AS r FROM firsts)),
          near AS (SELECT x.line, y.line AS other, y.first FROM halved x JOIN halved y
              ON x.r = y.r AND x.head = y.head AND y.first < x.first
            UNION SELECT x.line, y.line, y.first FROM halved x JOIN halved y
              ON x.r = y.r AND x.tail = y.tail AND y.first < x.first),
          earliest AS (SELECT line, min(first) AS earliest FROM (SELECT line, first FROM firsts
            UNION ALL SELECT line, first FROM near WHERE levenshtein(line, other) <= 1) GROUP BY line),
          kept AS (SELECT rid, string_agg(line, chr(10) ORDER BY pos) AS body FROM placed LEFT JOIN earliest USING (line)
            WHERE earliest IS NULL OR place <= earliest GROUP BY rid),
          counted AS (SELECT doc_id, CASE WHEN text <> '' THEN len(string_split(text, chr(10))) ELSE 0 END AS n_lines,
            coalesce(body, '') AS body FROM docs LEFT JOIN kept USING (rid))
          SELECT doc_id, n_lines, sha256(body) AS kept_sha256, length(body) AS n_kept_chars FROM counted""",
        "op4_pii": _personal_data(),
        "op5_exact_dedup": f"""
          WITH folded AS (SELECT doc_id, {_folded('text')} AS body FROM documents)
          SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
            sha256(body) AS text_sha256
          FROM folded WINDOW same AS (PARTITION BY body)""",
        "op8_jaccard": f"""
          WITH RECURSIVE words AS (SELECT doc_id, list_filter(
              string_split_regex({_folded('text')}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
            FROM documents),
          shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
              WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
              ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
              END) AS s FROM words),
          sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
          shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS same
            FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
          links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * same >= 90 * (p.n + q.n - same)),
          reached AS (SELECT doc_id, doc_id AS other FROM documents
            UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other)
          SELECT doc_id, coalesce(n, 0) AS n_shingles, least AS component_id
          FROM (SELECT doc_id, min(other) AS least FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)""",
        "op11_hard_negatives": f"""
          WITH given AS ({_VECTORS}),
          whole AS (SELECT id, CASE WHEN id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(v, lambda c: floor(256 * c)) AS v FROM given),
          scored AS (SELECT a.id AS anchor, b.id AS other, a.label = b.label AS same,
              CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
            FROM whole a JOIN whole b ON a.id <> b.id WHERE a.id % 100 = 0),
          positives AS (SELECT anchor, other AS positive, score AS top FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
          SELECT anchor AS anchor_id, positive AS positive_id,
            CAST(row_number() OVER best AS INTEGER) AS rank, other AS negative_id,
            top AS positive_score, score AS negative_score
          FROM positives JOIN scored USING (anchor)
          WHERE NOT same AND 80 * top <= 100 * score AND score <= top
          WINDOW best AS (PARTITION BY anchor, positive ORDER BY score DESC, other)
          QUALIFY row_number() OVER best <= 5""",
        "op12_near_vectors": f"""
          WITH RECURSIVE given AS ({_VECTORS} AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
          links AS (SELECT a.id AS a, b.id AS b FROM given a JOIN given b ON a.label = b.label AND a.id <> b.id
            WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
          reached AS (SELECT vec_id, vec_id AS other FROM embeddings
            UNION SELECT reached.vec_id, links.b FROM reached JOIN links ON links.a = reached.other)
          SELECT vec_id, coalesce(n, 0) AS n_links, least AS component_id, vec_id = least AS kept
          FROM (SELECT vec_id, min(other) AS least FROM reached GROUP BY vec_id)
          LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)""",
    }

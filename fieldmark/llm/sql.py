"""SQL that must agree with queries, where SQL can say what they return."""

_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _named(links: str) -> str:
    """Smallest id that each id reaches, itself included, over ``links`` (a, b), which hold both directions."""
    return f"""reached(id, other) AS (SELECT a, b FROM {links} UNION SELECT reached.id, l.b FROM reached JOIN {links} l ON l.a = reached.other),
    named AS (SELECT id, min(other) AS least FROM reached GROUP BY id)"""


def jaccard(words: int, percent: int) -> str:
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWER.format(text="text"))} AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {words - 1}), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words - 1}, least(len(w), 1)) + 1)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * shared >= {percent} * (p.n + q.n - shared)),
{_named("links")}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(named.least, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN named ON named.id = d.doc_id
"""


def vectors(least: float) -> str:
    return f"""
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
  AND list_cosine_similarity(x.e, y.e) >= {least}),
{_named("links")},
c AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(c.n, 0) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id, vec_id <= coalesce(least, vec_id) AS kept
FROM v LEFT JOIN c ON c.a = vec_id LEFT JOIN named ON named.id = vec_id
"""


_BITS = "['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111']"
_BASE32 = f"""array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + list_sum(list_transform(range(0, 5), lambda k: CAST(substr(bits, 5 * i + k + 1, 1) AS INTEGER) * (16 >> k)))::INTEGER, 1)), '')"""

ARCHIVES = f"""
WITH h AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (SELECT *, array_to_string(list_transform(string_split(hex, ''), lambda c: {_BITS}[instr('0123456789abcdef', c)]), '') AS bits,
      max(page_id) OVER (PARTITION BY hex) AS top FROM h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM b
"""


def substring(words: int) -> str:
    return f"""
WITH w AS MATERIALIZED (SELECT doc_id, {_WORDS.format(text="text")} AS w FROM documents),
runs AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + {words - 1}), ' ')) AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {words - 2})) AS i FROM w WHERE len(w) >= {words})),
first AS (SELECT run, min(doc_id) AS least FROM runs GROUP BY run),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(i, i + {words})) AS i FROM runs JOIN first USING (run) WHERE doc_id > least),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""


MIDDLE = """
WITH u AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || doc_id) AS h FROM documents),
n AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
             WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, coalesce(array_to_string(list_slice(u, 1, a), ''), '') AS pre, coalesce(array_to_string(list_slice(u, a + 1, b), ''), '') AS mid,
             coalesce(array_to_string(list_slice(u, b + 1, n), ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p
"""


SQL = {
    "op13_fill_in_middle": MIDDLE,
    "op1_ngram_jaccard_join": jaccard(3, 90),
    "op4_embedding_near_dedup": vectors(0.98),
    "op7_warc": ARCHIVES,
    "op8_substring_dedup": substring(50),
}

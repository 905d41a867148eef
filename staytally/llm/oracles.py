"""DuckDB SQL for the queries of the subpackage that SQL can express."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_ITEM_WORDS = _ALNUM.format(_LOWER.format("coalesce(text, '')"))
_DOC_WORDS = _SPACED.format("coalesce(text, '')")
_LOW_WORDS = _SPACED.format(_LOWER.format("coalesce(text, '')"))

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR)) || ':' || {0} END"


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return f"sha256({' || '.join(_FIELD.format(f) for f in fields)})"


def _tree(name: str, leaves: str, levels: int) -> str:
    """Tables ``{name}0`` (tree, total, i, digest) up to the roots, and ``{name}_at{level}`` with what
    stands before and after each node in its run."""
    out = [f"{name}0 AS ({leaves})"]
    for level in range(levels):
        run = "PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN"
        hashed = f"total > {8**level}"
        out.append(f"""{name}_at{level} AS (SELECT tree, i,
  CASE WHEN {hashed} THEN coalesce(string_agg(digest, '') OVER
    ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS b,
  CASE WHEN {hashed} THEN coalesce(string_agg(digest, '') OVER
    ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS a FROM {name}{level})""")
        out.append(f"""{name}{level + 1} AS (SELECT tree, total, i // 8 AS i,
  CASE WHEN {hashed} THEN sha256(string_agg(digest, '' ORDER BY i)) ELSE any_value(digest) END AS digest
  FROM {name}{level} GROUP BY tree, total, i // 8)""")
    return ",\n".join(out)


def _climb(name: str, start: str, index: str, tree: str, levels: int) -> str:
    """Folds ``f`` and gathers the proof ``p`` level by level, from table ``start`` to ``{name}_up``."""
    out = []
    for level in range(levels):
        before = start if level == 0 else f"{name}_up{level}"
        after = f"{name}_up" if level == levels - 1 else f"{name}_up{level + 1}"
        out.append(f"""{after} AS (SELECT s.* REPLACE (
  CASE WHEN b IS NULL THEN f ELSE sha256(b || f || a) END AS f,
  CASE WHEN b IS NULL THEN p ELSE p || b || a END AS p)
  FROM {before} s JOIN {name}_at{level} n ON n.tree = s.{tree} AND n.i = s.{index} // {8**level})""")
    return ",\n".join(out)


#: A tree of up to 8 ** 7 documents for each of up to 8 ** 4 languages.
_DEEP, _WIDE = 7, 4
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), "
    "lambda c: ascii(c)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
)
_TOKENS = r"regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+')"


def _draw(k: int) -> str:
    return f"('0x' || substr(h, {8 * k - 7}, 8))::BIGINT"


ORACLES = {
    "op11_merkle_manifest": f"""
WITH RECURSIVE step(i, k, v) AS (
  SELECT range::BIGINT, 0, range::BIGINT FROM range(256) UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM step WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM step WHERE k = 8),
doc AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN {_leaf("low")} ELSE {_leaf("text")} END AS checked
  FROM (SELECT *, {_LOWER.format("text")} AS low FROM documents), crc),
ranked AS (
  SELECT *, coalesce('=' || lang, '') AS tree, count(*) OVER (PARTITION BY lang) AS total,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM doc),
{_tree("d", "SELECT tree, total, i, leaf AS digest FROM ranked", _DEEP)},
subroot AS (SELECT tree AS lang_tree, digest, count(*) OVER () AS total,
  row_number() OVER (ORDER BY tree) - 1 AS i, 'all' AS tree FROM d{_DEEP}),
{_tree("l", "SELECT tree, total, i, digest FROM subroot", _WIDE)},
lone AS (SELECT doc_id, tree, i, leaf, checked AS f, '' AS p FROM ranked),
{_climb("d", "lone", "i", "tree", _DEEP)},
trees AS (SELECT u.doc_id, u.leaf, u.f, u.p, s.digest AS subroot, s.i, s.tree
          FROM d_up u JOIN subroot s ON s.lang_tree = u.tree),
{_climb("l", "trees", "i", "tree", _WIDE)}
SELECT doc_id, leaf, subroot, root.digest AS root, sha256(p) AS proof_sha256, f AS folded_root,
  f = root.digest AS verified
FROM l_up, (SELECT digest FROM l{_WIDE}) root
""",
    "op12_warc_packages": """
WITH page AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
led AS (SELECT *, row_number() OVER (PARTITION BY html ORDER BY page_id NULLS LAST) > 1 AND n >= 100 AS again,
          first_value(page_id) OVER (PARTITION BY html ORDER BY page_id NULLS LAST) AS lead FROM page)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN lead END AS refers_to
FROM led
""",
    "op13_fill_middle": f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text, {_TOKENS} AS w,
               sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, w, len(w) AS n, {_draw(1)} % (len(w) + 1) AS x, {_draw(2)} % (len(w) + 1) AS y,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR {_draw(3)} % 100 >= 50 THEN 'plain'
         WHEN {_draw(4)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM doc),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(w[: least(x, y)], '') AS p,
    array_to_string(w[least(x, y) + 1 : greatest(x, y)], '') AS m,
    array_to_string(w[greatest(x, y) + 1 :], '') AS s
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
""",
    "op1_decontaminate": f"""
WITH item AS (SELECT item_id, {_ITEM_WORDS} AS words FROM benchmark),
sized AS (SELECT item_id, words, least(10, len(words)) AS k FROM item WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, k, list_slice(words, i, i + k - 1) AS w
  FROM (SELECT *, unnest(range(1, len(words) - k + 2)) AS i FROM sized)),
doc AS (SELECT doc_id, {_ITEM_WORDS} AS words FROM documents),
found AS (
  SELECT d.doc_id, d.i, d.k, windows.item_id
  FROM (SELECT doc_id, k, i, list_slice(words, i, i + k - 1) AS w
        FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i
              FROM doc, (SELECT DISTINCT k FROM sized) WHERE len(words) >= k)) d
  JOIN windows ON windows.k = d.k AND windows.w = d.w),
hit AS (SELECT doc_id, count(DISTINCT p) AS n
        FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM found) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op3_near_dedup": f"""
WITH RECURSIVE word AS (SELECT doc_id, {_LOW_WORDS} AS words FROM documents),
shingle AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [words]
    ELSE list_distinct([list_slice(words, i, i + 3) FOR i IN range(1, len(words) - 2)]) END AS s
  FROM word),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS w FROM shingle),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM one a JOIN one b ON a.w = b.w AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
  least(doc_id, coalesce(b, doc_id)) AS component_id, doc_id <= coalesce(b, doc_id) AS kept
FROM shingle LEFT JOIN least_of ON a = doc_id
""",
    "op8_line_dedup": f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
  SELECT doc_id, i, lines[i] AS line,
    {_LOWER.format("trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM split)),
often AS (SELECT k, max(doc_id) AS last FROM line WHERE length(k) >= 20
          GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT line.*, often.k IS NOT NULL AND last <> doc_id AS gone
           FROM line LEFT JOIN often USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op9_passage_dedup": f"""
WITH doc AS (SELECT doc_id, {_DOC_WORDS} AS words FROM documents),
win AS (SELECT doc_id, i, list_slice(words, i, i + 19) AS w
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM doc)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS r FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM ranked WHERE r > 1),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM doc)
  ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
""",
}

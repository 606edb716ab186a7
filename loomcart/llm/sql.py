"""DuckDB SQL for the operators that SQL can express, written from their contracts."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

EXACT_DEDUP = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  sha256(translate(coalesce(text, ''), {_WHITE}, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, count(*) AS group_size,
             arg_min(doc_id, (-length(text), doc_id)) AS keep_id FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 12], ' ') AS win, least(len(w), 13) AS n
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM m)) GROUP BY 1),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

MIXING = """
WITH RECURSIVE d AS (SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:15])::BIGINT AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
w AS (SELECT source, source_size, (CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight,
             (CASE k % 3 WHEN 0 THEN -0.5 WHEN 1 THEN 0 ELSE 0.5 END)::DOUBLE AS slope FROM s),
-- Pour the budget; sources above their cap stop there and the rest is shared again.
pour(step, capped) AS (
    SELECT 0, []::VARCHAR[] UNION ALL
    SELECT step + 1, next FROM (
        SELECT step, capped, (
            SELECT coalesce(list(source ORDER BY source), []) FROM w AS x
            WHERE list_contains(capped, source) OR 2 * source_size < weight * (
                SELECT (1.5 * sum(source_size) - coalesce(sum(2 * source_size) FILTER (list_contains(capped, source)), 0))
                       / sum(weight) FILTER (NOT list_contains(capped, source)) FROM w)) AS next
        FROM pour) WHERE len(next) > len(capped)),
last AS (SELECT capped FROM pour ORDER BY step DESC LIMIT 1),
level AS (SELECT (1.5 * sum(source_size) - coalesce(sum(2 * source_size) FILTER (list_contains(capped, source)), 0))
                 / sum(weight) FILTER (NOT list_contains(capped, source)) AS l FROM w, last),
t AS (SELECT source, source_size, slope, least((2 * source_size)::DOUBLE, l * weight) AS target FROM w, level),
c AS (SELECT doc_id, size, source_size, target, slope,
             sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size + size / 2 AS middle,
             floor(target / source_size) AS passes
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, (passes + (middle <= target - passes * source_size)::INT)::BIGINT AS copies FROM c)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies,
       CASE WHEN copies > 0 THEN 2.0::DOUBLE * least(1.0::DOUBLE, middle / target)
           / ((1.0::DOUBLE - slope) + sqrt((1.0::DOUBLE - slope) * (1.0::DOUBLE - slope)
              + 4.0::DOUBLE * slope * least(1.0::DOUBLE, middle / target))) END AS position
FROM x
"""

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.payload_digest = k.payload_digest AND payload_bytes >= 1000
"""

CHAT = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (SELECT *, md5(strlen(role)::VARCHAR || ':' || role || text) AS tie,
             CASE role WHEN 'user' THEN '[INST] ' WHEN 'assistant' THEN '<s> ' ELSE '<<SYS>> ' END
             || regexp_replace(CASE WHEN role IN ('user', 'assistant') THEN text
                 ELSE replace(replace(role, '\', '\\'), chr(10), '\n') || chr(10) || text END,
                 '([<\[])(\\*)(/?s>|<SYS>>|</SYS>>|/?INST\])', '\1\\\2\3', 'g')
             || CASE role WHEN 'user' THEN ' [/INST]' WHEN 'assistant' THEN ' </s>' ELSE ' <</SYS>>' END AS shown FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, tie)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, tie) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(shown))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


def _merkle() -> str:
    """Trees of eight children unrolled to ten levels, enough for a thousand million leaves."""
    levels = 10

    def field(value: str) -> str:
        return f"coalesce(strlen({value})::VARCHAR || ':' || {value}, '-')"

    def tower(name: str) -> list[str]:
        """Runs and the next level, from ``name``_l0 (tree, i, n, d) on."""
        ctes = []
        for k in range(levels):
            ctes += [f"{name}_r{k} AS (SELECT tree, i // 8 AS p, max(n) AS n, list(d ORDER BY i) AS run "
                     f"FROM {name}_l{k} WHERE n > 1 GROUP BY 1, 2)",
                     f"{name}_l{k + 1} AS (SELECT tree, p AS i, (n + 7) // 8 AS n, sha256(array_to_string(run, '')) AS d "
                     f"FROM {name}_r{k} UNION ALL SELECT tree, i, n, d FROM {name}_l{k} WHERE n = 1)"]
        return ctes

    steps, last = [], "w"
    for name, tree, place in (("a", "t.tree", "t.i"), ("u", "''", "t.u")):
        for k in range(levels):
            slot = f"(({place} // {8 ** k}) % 8)"
            before = f"array_to_string(run[1:{slot}], '')"
            after = f"array_to_string(run[{slot} + 2:], '')"
            step = f"{name}_s{k}"
            steps.append(
                f"{step} AS (SELECT t.* EXCLUDE (proof, folded), CASE WHEN run IS NULL THEN proof ELSE proof || {before} "
                f"|| {after} END AS proof, CASE WHEN run IS NULL THEN folded ELSE sha256({before} || folded || {after}) END "
                f"AS folded FROM {last} AS t LEFT JOIN {name}_r{k} AS r ON r.tree = {tree} AND r.p = {place} // {8 ** (k + 1)})")
            last = step
    crc = ("xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), "
           "lambda c: ascii(c)::UBIGINT), lambda x, b: list_reduce([xor(x, b)] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0], "
           "lambda y, z: xor(y >> 1, 3988292384::UBIGINT * (y & 1)))), 4294967295::UBIGINT)")
    head = " || ".join(field(f"{c}::VARCHAR") for c in ("doc_id", "source", "lang", "n_chars"))
    now = f"CASE WHEN {crc} % 3 = 0 THEN {_LOWER.format('text')} ELSE text END"
    return f"""
WITH w0 AS (SELECT doc_id, coalesce('v' || lang, 'n') AS tree, {head} AS head, text, {now} AS now FROM documents),
w1 AS (SELECT doc_id, tree, sha256(head || {field("text")}) AS d, sha256(head || {field("now")}) AS folded FROM w0),
w2 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS i,
              count(*) OVER (PARTITION BY tree) AS n FROM w1),
a_l0 AS (SELECT tree, i, n, d FROM w2), {", ".join(tower("a"))},
tops AS (SELECT tree AS name, d, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM a_l{levels}),
u_l0 AS (SELECT '' AS tree, i, n, d FROM tops), {", ".join(tower("u"))},
w AS (SELECT w2.*, tops.d AS subroot, tops.i AS u, (SELECT d FROM u_l{levels}) AS root, '' AS proof
      FROM w2 JOIN tops ON tops.name = w2.tree), {", ".join(steps)}
SELECT doc_id, d AS leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM {last}
"""


MERKLE = _merkle()

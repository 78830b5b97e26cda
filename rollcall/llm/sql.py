"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


def _share(level: str, source: str, parent: str) -> str:
    """One level of the budget tree: siblings by capacity over weight, the full ones first."""
    over = f"PARTITION BY {parent}" if parent else ""
    order = f"{over} ORDER BY capacity / weight, {level} NULLS FIRST"
    return f"""
    SELECT * EXCLUDE (budget, filled, free_weight),
      CASE WHEN filled THEN capacity
           ELSE CAST((rest * upto) // total - (rest * (upto - weight)) // total AS BIGINT) END AS budget
    FROM (
      SELECT *,
        CAST(budget - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER ({over}) AS HUGEINT) AS rest,
        sum(free_weight) OVER ({over}) AS total,
        sum(free_weight) OVER ({order} ROWS UNBOUNDED PRECEDING) AS upto
      FROM (
        SELECT *, CASE WHEN filled THEN 0 ELSE weight END AS free_weight
        FROM (
          SELECT *,
            CAST(capacity AS HUGEINT) * sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= CAST(budget - coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                    AS HUGEINT) * weight AS filled
          FROM {source}
        )
      )
    )"""


def mix_ctes(seed: str, max_epochs: int, docs: str) -> str:
    """CTEs up to ``mixed``: the chosen rows of ``docs`` with domain, n_tokens and epoch."""
    return f"""
  mix_rows AS (
    SELECT *, len({WORDS.format("coalesce(text, '')")}) AS n_tokens,
      CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) = '' THEN 'other'
           ELSE 'domain' || CAST(CAST(nullif(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1), '') AS INT) % 4 AS VARCHAR)
      END AS domain
    FROM {docs}
  ),
  leaves AS (
    SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) * {max_epochs} AS BIGINT) AS capacity
    FROM mix_rows GROUP BY ALL HAVING sum(n_tokens) > 0
  ),
  d0 AS (
    SELECT domain, CAST(sum(capacity) AS BIGINT) AS capacity,
      CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END AS weight,
      (SELECT CAST(least(sum(tokens) * 6 // 10, sum(capacity)) AS BIGINT) FROM leaves) AS budget
    FROM leaves GROUP BY domain
  ),
  d1 AS ({_share("domain", "d0", "")}),
  l0 AS (
    SELECT l.domain, l.lang, CAST(sum(l.capacity) AS BIGINT) AS capacity,
      CASE l.lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS weight, any_value(d1.budget) AS budget
    FROM leaves l JOIN d1 ON l.domain IS NOT DISTINCT FROM d1.domain GROUP BY l.domain, l.lang
  ),
  l1 AS ({_share("lang", "l0", "domain")}),
  s0 AS (
    SELECT l.*, 1 AS weight, l1.budget
    FROM leaves l JOIN l1 ON l.domain IS NOT DISTINCT FROM l1.domain AND l.lang IS NOT DISTINCT FROM l1.lang
  ),
  s1 AS ({_share("source", "s0", "domain, lang")}),
  keyed AS (
    SELECT r.*, coalesce(s1.budget // s1.tokens, 1) AS whole, coalesce(s1.budget % s1.tokens, 0) AS remainder,
      sum(r.n_tokens) OVER (PARTITION BY r.domain, r.lang, r.source
        ORDER BY substr(sha256('{seed}:' || CAST(s1.budget // s1.tokens + 1 AS VARCHAR) || ':' || coalesce(CAST(r.doc_id AS VARCHAR), '')
                 || ':' || sha256(coalesce(r.text, ''))), 1, 15), r.doc_id ROWS UNBOUNDED PRECEDING) AS upto
    FROM mix_rows r LEFT JOIN s1 ON r.domain IS NOT DISTINCT FROM s1.domain AND r.lang IS NOT DISTINCT FROM s1.lang
      AND r.source IS NOT DISTINCT FROM s1.source
  ),
  mixed AS (
    SELECT *, unnest(range(1, 1 + CAST(whole + CASE WHEN remainder > 0 AND upto <= remainder THEN 1 ELSE 0 END AS BIGINT))) AS epoch
    FROM keyed
  )"""


FEATURES = rf"""
  split AS (
    SELECT doc_id, lang, coalesce(text, '') AS t, {WORDS.format("coalesce(text, '')")} AS w,
      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
      row_number() OVER () AS rid
    FROM documents
  ),
  triples AS (
    SELECT rid, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS triple,
      unnest(range(1, len(w) - 1)) AS i
    FROM split
  ),
  windows AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, triple) AS n FROM triples),
  covered AS (
    SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY rid
  ),
  features AS (
    SELECT doc_id, lang, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
      len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
      len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
      len(list_filter(w, lambda x: ends_with(x, '!!'))) AS n_shouts
    FROM split LEFT JOIN covered c USING (rid)
  ),
  failed AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
      CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS symbol_rate,
      CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_line_rate,
      CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeat_rate,
      CASE WHEN n_words > 0 THEN n_shouts * 1000 // n_words ELSE 0 END AS shout_rate
    FROM features
  ),
  stepped AS (
    SELECT *, least(
        CASE WHEN symbol_rate > 0 THEN 50 - least(49, (symbol_rate - 1) // 20) END,
        CASE WHEN shout_rate > 0 THEN 100 - least(49, (shout_rate - 1) // 20) END,
        CASE WHEN repeat_rate > 0 THEN 150 - least(49, (repeat_rate - 1) // 20) END,
        CASE WHEN dup_line_rate > 0 THEN 200 - least(49, (dup_line_rate - 1) // 20) END) AS step
    FROM failed
  ),
  holdout AS (
    SELECT lang, step FROM stepped WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
  ),
  strata AS (SELECT lang, count(*) AS n, 0.98 ** count(*) AS least_p FROM holdout GROUP BY lang),
  level AS (
    SELECT 0.05 / min(m) AS level FROM (SELECT row_number() OVER () AS m FROM strata) r
    WHERE (SELECT count(*) FROM strata WHERE least_p * m <= 0.05) <= m
  ),
  tried AS (
    SELECT lang, s, count(*) AS n, count(*) FILTER (WHERE step <= s) AS k FROM holdout, range(0, 201) AS r(s) GROUP BY ALL
  ),
  failing AS (
    SELECT lang, min(s) AS s FROM tried, level
    WHERE k > n * 0.02 OR list_sum(list_transform(range(0, k + 1), lambda j:
        exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.02) + (n - j) * ln(0.98)))) > level
    GROUP BY lang
  ),
  certified AS (
    SELECT t.lang, greatest(coalesce(f.s - 1, 200), 0) AS step
    FROM strata t LEFT JOIN failing f ON t.lang IS NOT DISTINCT FROM f.lang
  )
"""


#: CRC-32 in plain SQL: a table of 256 remainders, and a fold over a list of bytes.
CRC_TABLE = """
  crc_table AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, step: xor(v >> 1, (v & 1) * 3988292384)) ORDER BY i) AS crc
    FROM range(256) AS t(i)
  )"""


def crc32(byte_list: str) -> str:
    fold = "lambda v, b: xor(crc[CAST((xor(v, b) & 255) + 1 AS BIGINT)], v >> 8)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {byte_list}), {fold}), 4294967295::BIGINT)"


ORACLES = {
    "op4_budgeted_chat": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
  ),
  sized AS (
    SELECT *, (length(text) + 3) // 4 + 4 AS tokens,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
      11 + length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</', '<\/'), ':', '\:'))
        + length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</', '<\/')) + 3 AS chars
    FROM turns
  ),
  parted AS (
    SELECT *, place = 1 AND lower(role) = 'system' AS is_system,
      max(CASE WHEN place = 1 AND lower(role) = 'system' THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS system
    FROM sized
  ),
  budgeted AS (
    SELECT *, greatest(least(128, CAST(floor((512 - system) / 3) AS BIGINT)), 0) AS reach, CASE WHEN is_system THEN 0 ELSE tokens END AS counted
    FROM parted
  ),
  placed AS (
    SELECT *, greatest(512 - system - reach, 1) AS stride, sum(counted) OVER (PARTITION BY conv_id ORDER BY place) - counted AS start FROM budgeted
  ),
  celled AS (
    SELECT *, start // stride AS cell, NOT is_system AND start + counted > (start // stride + 1) * stride AS crosses FROM placed
  ),
  spans AS (
    SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY CASE WHEN is_system THEN 0 WHEN place = 2 AND system > 0 THEN 0
      ELSE 2 * cell + crosses::INT + 1 END) AS any_rank FROM celled
  ),
  own AS (
    -- Behind a system turn the second turn is in the first window, with those of its cell if it does not cross.
    SELECT *, CASE WHEN system > 0 AND NOT first_value(crosses) OVER (PARTITION BY conv_id ORDER BY place = 2 DESC)
        AND cell = 0 AND NOT crosses THEN 1 ELSE any_rank END AS win
    FROM spans
  ),
  wins AS (
    SELECT conv_id, win, min(start) AS s, sum(tokens) AS own_tokens, any_value(system) AS system, bool_or(is_system) AS holds_system
    FROM own GROUP BY conv_id, win
  ),
  repeated AS (
    SELECT t.conv_id, w.win, t.tokens, t.chars FROM own t JOIN wins w
      ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND w.win > t.win AND NOT t.is_system AND t.start >= w.s - t.reach
  ),
  context AS (SELECT conv_id, win, sum(tokens) AS tokens, sum(chars) AS chars FROM repeated GROUP BY conv_id, win),
  filled AS (
    SELECT w.conv_id, own_tokens + coalesce(c.tokens, 0) + CASE WHEN holds_system THEN 0 ELSE system END AS tokens, coalesce(c.chars, 0) AS chars
    FROM wins w LEFT JOIN context c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.win = c.win
  ),
  per_conv AS (
    SELECT conv_id, count(*) AS n_windows, count(*) FILTER (WHERE tokens > 512) AS n_over_budget, sum(chars) AS chars FROM filled GROUP BY conv_id
  )
SELECT o.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(o.chars) + any_value(p.chars) + coalesce(sum(o.chars) FILTER (WHERE is_system), 0) * (any_value(n_windows) - 1) AS BIGINT) AS formatted_chars,
  any_value(n_windows) AS n_windows, any_value(n_over_budget) AS n_over_budget
FROM own o JOIN per_conv p ON o.conv_id IS NOT DISTINCT FROM p.conv_id GROUP BY o.conv_id
""",
    "op9_certified_quality": f"""
WITH {FEATURES}
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR coalesce(f.step <= c.step, false)) AS kept
FROM stepped f LEFT JOIN certified c ON f.lang IS NOT DISTINCT FROM c.lang
""",
    "op10_hierarchical_mix": f"""
WITH {mix_ctes("rollcall-mix", 2, "documents")}
SELECT doc_id, domain, lang, source, n_tokens, CAST(epoch AS INT) AS epoch FROM mixed
""",
    "op11_conversation_trie": f"""
WITH {CRC_TABLE},
  own AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
  ),
  taken AS (
    SELECT *, {crc32("list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))")} % 6 AS h
    FROM own, crc_table
  ),
  rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, h), []), list_slice(c.turns, h + 1, len(c.turns))) AS seq
    FROM taken c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
  ),
  nodes AS (
    SELECT d AS depth, list_slice(seq, 1, d) AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
      sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(seq) = d), '')) AS ends_sha256
    FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt) GROUP BY ALL
  ),
  linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id,
      (n.n_convs - 1) * CASE WHEN n.depth = 0 THEN 0 ELSE length(n.prefix[n.depth].t) END AS saved
    FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = list_slice(n.prefix, 1, n.depth - 1)
  ),
  children AS (
    SELECT depth - 1 AS depth, list_slice(prefix, 1, depth - 1) AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
  ),
  counted AS (SELECT l.*, coalesce(c.n, 0) AS n_children FROM linked l LEFT JOIN children c USING (depth, prefix)),
  below AS (
    SELECT d AS depth, list_slice(prefix, 1, d) AS prefix, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY ALL
  )
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM counted JOIN below USING (depth, prefix)
""",
    "op12_spelling_variants": f"""
WITH RECURSIVE {CRC_TABLE},
  runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]{{5,}}')) AS run FROM documents)
    GROUP BY ALL
  ),
  coded AS (
    SELECT run, n, {crc32("flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda x: "
      "CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END))")} AS h
    FROM runs, crc_table
  ),
  words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM coded)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
  ),
  cuts AS (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
  ),
  near AS (
    SELECT a.word, b.word AS near FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT c.word, w.word FROM cuts c JOIN words w ON c.rest = w.word
    UNION SELECT w.word, c.word FROM cuts c JOIN words w ON c.rest = w.word
  ),
  ranked AS (
    SELECT a.word, a.near, w.n AS near_n, count(*) OVER (PARTITION BY a.word) AS n_near,
      row_number() OVER (PARTITION BY a.word ORDER BY w.n DESC, a.near) AS place
    FROM near a JOIN words w ON a.near = w.word
  ),
  formed AS (
    SELECT w.word, w.n, CASE WHEN r.near_n >= 2 * w.n THEN r.near END AS form, CASE WHEN r.near_n >= 2 * w.n THEN r.near_n END AS form_n,
      coalesce(r.n_near, 0) AS n_near
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1
  ),
  ways AS (
    SELECT word, word AS root, 0 AS steps FROM formed
    UNION ALL SELECT y.word, f.form, y.steps + 1 FROM ways y JOIN formed f ON f.word = y.root WHERE f.form IS NOT NULL
  )
SELECT f.word, n, form, form_n, n_near, y.root
FROM formed f JOIN (SELECT word, arg_max(root, steps) AS root FROM ways GROUP BY word) y USING (word)
""",
    "op13_embedding_near_dedup": """
WITH RECURSIVE vectors AS (
    SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  ),
  usable AS (
    SELECT * FROM vectors
    WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(v, v) > 0
  ),
  links AS (
    SELECT a.rid AS a, b.rid AS b FROM usable a JOIN usable b ON a.rid <> b.rid AND len(a.v) = len(b.v)
    WHERE list_inner_product(a.v, b.v) >= 0.95 * sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))
  ),
  reach AS (SELECT rid AS a, rid AS b FROM vectors UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
  least AS (SELECT r.a, min(v.vec_id) AS component_id FROM reach r JOIN vectors v ON r.b = v.rid GROUP BY r.a)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE a = v.rid) AS n_links, component_id, v.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM vectors v JOIN least l ON l.a = v.rid
""",
}

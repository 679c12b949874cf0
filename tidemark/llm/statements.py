"""DuckDB statements of the results of those queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import mixing, secret_scan

_BEGIN, _END = "<|im_start|>", "<|im_end|>"

def _shown(turns: str) -> str:
    mark = "replace({}, '<|im_', '<| im_')"
    return (
        f"list_transform({turns}, lambda t: '{_BEGIN}' || {mark.format('t.role')} || chr(10)"
        f" || {mark.format('t.text')} || '{_END}' || chr(10))"
    )


def _loss(side: str) -> str:
    before = f"coalesce(list_sum(list_transform({side}[1:i - 1], lambda s: length(s))), 0)::BIGINT"
    head = f"length({side}_roles[i]) + {len(_BEGIN) + 1}"
    return (
        f"coalesce(array_to_string(list_transform(list_filter(range(1, len({side}) + 1), lambda i: {side}_roles[i] = 'assistant'),"
        f" lambda i: ({before} + {head})::VARCHAR || ':' || ({before} + length({side}[i]) - 1)::VARCHAR), ','), '')"
    )


PREFERENCE = f"""
WITH whole AS (
  SELECT conv_id, list({{'turn': turn, 'role': coalesce(role, 'unknown'), 'text': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS turns
  FROM conversations GROUP BY conv_id
), placed AS (
  SELECT *, md5(turns[1].role || chr(10) || turns[1].text) AS opening FROM whole
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY opening ORDER BY conv_id NULLS FIRST) AS n FROM placed
), paired AS (
  SELECT a.conv_id AS chosen_id, b.conv_id AS rejected_id, a.turns AS chosen, b.turns AS other, b.turns IS NULL AS alone,
    list_max(list_filter(range(2, len(a.turns) + 1), lambda i: a.turns[i].role = 'assistant')) AS last
  FROM numbered a LEFT JOIN numbered b ON a.opening = b.opening AND b.n = a.n + 1
  WHERE a.n % 2 = 1
), sided AS (
  SELECT chosen_id, rejected_id, chosen,
    CASE WHEN NOT alone THEN other ELSE list_transform(range(1, len(chosen) + 1), lambda i:
      CASE WHEN i = last THEN {{'turn': chosen[i].turn, 'role': chosen[i].role, 'text': chosen[i - 1].text}} ELSE chosen[i] END) END AS rejected
  FROM paired
), counted AS (
  SELECT *, coalesce(list_min(list_filter(range(1, greatest(len(chosen), len(rejected)) + 1), lambda i:
      i > len(chosen) OR i > len(rejected) OR chosen[i].role <> rejected[i].role OR chosen[i].text <> rejected[i].text)),
    greatest(len(chosen), len(rejected)) + 1) - 1 AS shared
  FROM sided
), parts AS (
  SELECT chosen_id, rejected_id, shared AS prompt_turns,
    chosen[1:shared] AS p, chosen[shared + 1:] AS c, rejected[shared + 1:] AS r
  FROM counted
), shown AS (
  SELECT chosen_id, rejected_id, prompt_turns,
    {_shown("p")} AS p, {_shown("c")} AS c, {_shown("r")} AS r,
    list_transform(c, lambda t: t.role) AS c_roles, list_transform(r, lambda t: t.role) AS r_roles
  FROM parts
)
SELECT chosen_id, rejected_id, prompt_turns::BIGINT AS prompt_turns, len(c)::BIGINT AS chosen_turns, len(r)::BIGINT AS rejected_turns,
  sha256(coalesce(array_to_string(p, ''), '')) AS prompt_sha256, sha256(coalesce(array_to_string(c, ''), '')) AS chosen_sha256,
  sha256(coalesce(array_to_string(r, ''), '')) AS rejected_sha256, {_loss("c")} AS chosen_loss, {_loss("r")} AS rejected_loss
FROM shown
"""


def _secrets() -> str:
    """Matches stand between the pieces that splitting leaves, so lengths add up to places."""
    rules = secret_scan.BASE + secret_scan.MORE
    lists, kinds = [], []
    for number, rule in enumerate(rules):
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        lists.append(
            f"string_split_regex(body, {pattern}) AS gaps{number}, regexp_extract_all(body, {pattern}) AS found{number},"
            f" regexp_extract_all(body, {pattern}, {rule.group}) AS checked{number}"
        )
        sums = f"list_sum(list_transform(gaps{number}[1:i], lambda s: length(s))) + coalesce(list_sum(list_transform(found{number}[1:{{}}], lambda s: length(s))), 0)"
        kinds.append(
            f"list_transform(list_filter(range(1, len(found{number}) + 1), lambda i: length(checked{number}[i]) >= {rule.least}),"
            f" lambda i: {{'start': ({sums.format('i - 1')})::BIGINT, 'number': {number}, 'stop': ({sums.format('i')})::BIGINT}})"
        )
    names = "[" + ", ".join(f"'{rule.kind}'" for rule in rules) + "]"
    shown = f"list_transform({{}}, lambda s: {names}[s.number + 1] || ':' || s.start::VARCHAR || ':' || s.stop::VARCHAR)"
    counts = ", ".join(
        f"len(list_filter(spans, lambda s: s.number = {n}))::BIGINT AS n_{rule.kind}" for n, rule in enumerate(secret_scan.BASE)
    )
    base = f"list_filter(spans, lambda s: s.number < {len(secret_scan.BASE)})"
    return f"""
WITH bodies AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
cuts AS (SELECT doc_id, {", ".join(lists)} FROM bodies),
matches AS (SELECT doc_id, list_sort(flatten([{", ".join(kinds)}])) AS spans FROM cuts)
SELECT doc_id, {counts}, sha256(coalesce(array_to_string({shown.format(base)}, ','), '')) AS base_sha256,
  coalesce(array_to_string({shown.format("spans")}, ','), '') AS spans
FROM matches
"""


EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

MIX = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    md5('{mixing.SEED}' || coalesce(':' || doc_id::VARCHAR, '')) AS key
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, {list(mixing.WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1]::DOUBLE AS weight,
    source_size * {mixing.MOST_EPOCHS} AS stop
  FROM sizes
), ordered AS (
  SELECT *, stop / weight AS stops_at,
    coalesce(sum(stop) OVER before, 0)::DOUBLE AS stops_before, coalesce(sum(weight) OVER before, 0) AS weights_before,
    sum(source_size) OVER () AS all_sizes, sum(weight) OVER () AS all_weights
  FROM weighed
  WINDOW before AS (ORDER BY stop / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, (all_sizes::DOUBLE * {mixing.SHARE} - stops_before) / (all_weights - weights_before) AS level FROM ordered
), found AS (
  SELECT arg_min(level, weights_before) FILTER (stops_at >= level) AS height FROM levels
), targets AS (
  SELECT source, source_size, least(stop, coalesce(height * weight, stop))::DOUBLE AS target FROM levels, found
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized
), goals AS (
  SELECT doc_id, size, source_size, target, before, round(target)::BIGINT AS goal,
    CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs
  FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, goal - epochs * source_size - before)))::BIGINT AS taken
FROM goals
"""

# all pairs that share a shingle, and all that links lead to
NEAR = f"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{"".join(map(chr, range(65, 91)))}', '{"".join(map(chr, range(97, 123)))}'),
      '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT r, unnest(list_distinct(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END)) AS shingle
  FROM split WHERE len(w) > 0
), sizes AS (
  SELECT r, count(*) AS n FROM sets GROUP BY r
), shared AS (
  SELECT a.r AS a, b.r AS b, count(*) AS k FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.r < b.r GROUP BY a.r, b.r
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT r AS a, r AS b FROM split UNION SELECT reached.a, ways.b FROM reached JOIN ways ON reached.b = ways.a
), least AS (
  SELECT a AS r, min(doc_id) AS component_id FROM reached JOIN split ON split.r = reached.b GROUP BY a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM split JOIN least USING (r) LEFT JOIN sizes USING (r)
"""


ARCHIVED = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS bytes FROM pages
), stored AS (
  SELECT *, CASE WHEN bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload) ELSE page_id END AS response FROM payloads
)
SELECT page_id, bytes::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM stored
"""


# products are added up from the first component to the last, as the query does, so that the sums are the same
NEAREST = """
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), usable AS (
  SELECT * FROM vectors
  WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS other,
    list_reduce(list_prepend(0::DOUBLE, list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), lambda a, b: a + b) AS score
  FROM usable q JOIN usable c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, other)::INTEGER AS rank, vec_id, score FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


_H = [f"('0x' || substr(hexes, {8 * k + 1}, 8))::UBIGINT" for k in range(4)]

FILL_IN_MIDDLE = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS hexes FROM documents
), cut AS (
  SELECT doc_id, text, {_H[0]} AS h1, {_H[1]} AS h2, {_H[2]} AS h3, {_H[3]} AS h4,
    CASE WHEN text = '' THEN [] WHEN text LIKE '%' || chr(10) THEN list_transform(string_split(text, chr(10))[:-2], lambda l: l || chr(10))
    ELSE list_concat(list_transform(string_split(text, chr(10))[:-2], lambda l: l || chr(10)), [string_split(text, chr(10))[-1]]) END AS lines
  FROM texts
), placed AS (
  SELECT *, len(lines)::BIGINT AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a, greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b
  FROM cut
), parts AS (
  SELECT *, coalesce(array_to_string(lines[1:a::BIGINT], ''), '') AS prefix,
    coalesce(array_to_string(lines[a::BIGINT + 1:b::BIGINT], ''), '') AS middle,
    coalesce(array_to_string(lines[b::BIGINT + 1:n], ''), '') AS suffix,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
    WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM placed
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


def _manifest(levels: int = 8, levels_of_groups: int = 4) -> str:
    """The manifest of at most 8^levels documents of each of at most 8^levels_of_groups languages."""

    def framed(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(framed(v) for v in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    def joined(over: str) -> str:
        return f"coalesce(string_agg(h, '') OVER (PARTITION BY grp, p // 8 ORDER BY p ROWS BETWEEN {over}), '')"

    def tree(name: str, leaves: str, height: int) -> list[str]:
        """Nodes of each level with their siblings, then for each leaf its siblings of all levels."""
        parts = [f"{name}0 AS ({leaves})"]
        for k in range(height):
            parts.append(
                f"{name}{k + 1} AS (SELECT grp, p // 8 AS p, CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h,"
                f" (n + 7) // 8 AS n FROM {name}{k} GROUP BY grp, p // 8, n)"
            )
            parts.append(
                f"{name}_beside{k} AS (SELECT grp, p, n, {joined('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS l,"
                f" {joined('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS r FROM {name}{k})"
            )
        return parts

    def path(name: str, at: str, group: str, height: int) -> str:
        return " ".join(
            f"JOIN {name}_beside{k} {name}s{k} ON {name}s{k}.grp IS NOT DISTINCT FROM {group} AND {name}s{k}.p = {at} // {8**k}" for k in range(height)
        )

    steps = [*(f"ls{k}" for k in range(levels)), *(f"ts{k}" for k in range(levels_of_groups))]
    folds, own = [], "folded"
    for number, step in enumerate(steps):
        source = "placed" if number == 0 else f"fold{number - 1}"
        folds.append(
            f"fold{number} AS (SELECT * REPLACE (CASE WHEN {step}_n = 1 THEN folded ELSE sha256({step}_l || {own} || {step}_r) END AS folded) FROM {source})"
        )
    beside = ", ".join(f"{s}.n AS {s}_n, {s}.l AS {s}_l, {s}.r AS {s}_r" for s in steps)
    # the CRC's table of 256 entries by eight steps of one bit each, then one lookup for each byte
    bit = "list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    crc = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ord(d)::BIGINT)), lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)])), 4294967295)"
    lowered = f"translate(text, '{''.join(map(chr, range(65, 91)))}', '{''.join(map(chr, range(97, 123)))}')"
    ctes = [
        f"crcs AS (SELECT list(v ORDER BY i) AS crc FROM (SELECT i, {bit} AS v FROM (SELECT unnest(range(256)) AS i)))",
        f"leaves AS (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(lowered)} END AS changed FROM documents, crcs)",
        "numbered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot, count(*) OVER (PARTITION BY lang) AS n FROM leaves)",
        *tree("l", "SELECT lang AS grp, spot AS p, leaf AS h, n FROM numbered", levels),
        f"subroots AS (SELECT grp AS lang, h AS subroot, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM l{levels})",
        *tree("t", "SELECT 0 AS grp, place AS p, subroot AS h, n FROM subroots", levels_of_groups),
        "placed AS (SELECT numbered.doc_id, numbered.leaf, subroots.subroot, coalesce(numbered.changed, numbered.leaf) AS folded, "
        f"(SELECT h FROM t{levels_of_groups}) AS root, {beside} FROM numbered JOIN subroots ON subroots.lang IS NOT DISTINCT FROM numbered.lang"
        f" {path('l', 'numbered.spot', 'numbered.lang', levels)} {path('t', 'subroots.place', '0', levels_of_groups)})",
        *folds,
    ]
    proof = " || ".join(f"{s}_l || {s}_r" for s in steps)
    return (
        f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, folded AS folded_root,"
        f" folded = root AS verified FROM fold{len(steps) - 1}"
    )


STATEMENTS = {
    "op1_preference": PREFERENCE,
    "op2_secrets": _secrets(),
    "op5_warc": ARCHIVED,
    "op7_exact_dedup": EXACT_DEDUP,
    "op8_near_dedup": NEAR,
    "op9_nearest": NEAREST,
    "op10_mix": MIX,
    "op11_manifest": _manifest(),
    "op13_fill_in_middle": FILL_IN_MIDDLE,
}

"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from bronzeflow.llm import decontamination, filter_audit, hard_negatives, host_rules, mixing, secrets, substrings

_SPACE = r"[ \t\n\x0B\x0C\r]+"


def _words(text: str, separator: str = _SPACE) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '{separator}'), lambda x: x <> '')"


def _lower(text: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"translate({text}, '{upper}', '{upper.lower()}')"


def _secrets() -> str:
    rules = secrets.BASE_RULES + secrets.ADDED_RULES
    parts = []
    for number, rule in enumerate(rules):
        pattern = rule.pattern.replace("'", "''")
        parts.append(
            f"""SELECT doc_id, {number} AS number, '{rule.kind}' AS kind, {rule.least} AS least,
                list_transform(string_split_regex(t, '{pattern}'), lambda x: length(x)) AS gaps,
                list_transform(regexp_extract_all(t, '{pattern}'), lambda x: length(x)) AS sizes,
                list_transform(regexp_extract_all(t, '{pattern}', {rule.group}), lambda x: length(x)) AS vals
            FROM texts WHERE regexp_matches(t, '{pattern}')"""
        )
    base = len(secrets.BASE_RULES)
    joined = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number, stop)"
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    found AS ({" UNION ALL ".join(parts)}),
    spots AS (SELECT doc_id, number, kind, least, gaps, sizes, vals, unnest(range(1, len(sizes) + 1)) AS i FROM found),
    spans AS (
        SELECT doc_id, number, kind, vals[i] AS val, least,
            (list_sum(gaps[1:i]) + coalesce(list_sum(sizes[1:i - 1]), 0))::BIGINT AS start,
            (list_sum(gaps[1:i]) + list_sum(sizes[1:i]))::BIGINT AS stop
        FROM spots),
    kept AS (SELECT * FROM spans WHERE val >= least),
    told AS (
        SELECT doc_id, count(*) FILTER (number = 0) AS n_assign, count(*) FILTER (number = 1) AS n_access,
            count(*) FILTER (number = 2) AS n_hex, {joined} AS spans, {joined} FILTER (number < {base}) AS base
        FROM kept GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM texts LEFT JOIN told USING (doc_id)"""


def _host_rules() -> str:
    r = host_rules.HostRules()
    return f"""
    WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS t, {_words("text")} AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\x0C\\r]')) AS lines FROM documents),
    spots AS (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM texts WHERE len(words) >= 3),
    windows AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w FROM spots),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY doc_id),
    measured AS (
        SELECT doc_id, source, len(words)::BIGINT AS n_words, length(regexp_replace(t, '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(lines) AS n_lines,
            (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
        FROM texts LEFT JOIN covered USING (doc_id)),
    failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured),
    hosts AS (
        SELECT source, count(*) AS n, sum((base_failed OR 100 * n_symbols > {r.symbol_percent} * word_chars
            OR 100 * n_dup_lines > {r.dup_line_percent} * n_lines)::INT) AS bad
        FROM failed GROUP BY source),
    usual AS (SELECT n, bad / n AS raw FROM hosts WHERE n >= least({r.least_docs}, (SELECT max(n) FROM hosts))),
    middle AS (SELECT raw AS m FROM usual QUALIFY row_number() OVER (ORDER BY raw) = ceil(count(*) OVER () / 2.0)),
    spreads AS (SELECT m, greatest(avg(pow(raw - m, 2) - m * (1 - m) / n), 0) AS v FROM usual, middle WHERE raw <= m GROUP BY m),
    prior AS (
        SELECT m, greatest({r.moderate}, m + greatest({r.margin}, {r.sure} * sqrt(v))) AS top,
            CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), {r.most_weight}) ELSE {r.most_weight} END AS k FROM spreads),
    rates AS (SELECT source, n + k + 1 AS size, top, (bad + m * k) / (n + k) AS rate FROM hosts, prior)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND rate < {r.reject_rate} AND rate - {r.sure} * sqrt(rate * (1 - rate) / size) <= top AS kept
    FROM failed JOIN rates ON failed.source IS NOT DISTINCT FROM rates.source"""


def _near_duplicates(size: int = 4, percent: int = 80) -> str:
    run = " || ' ' || ".join(f"words[i + {d}]" for d in range(size))
    return f"""
    WITH RECURSIVE texts AS (SELECT doc_id, {_words(_lower("text"))} AS words FROM documents),
    spots AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {size - 1}, 1) + 1)) AS i FROM texts WHERE len(words) > 0),
    sets AS (SELECT DISTINCT doc_id, CASE WHEN len(words) < {size} THEN array_to_string(words, ' ') ELSE {run} END AS s FROM spots),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
    reach AS (SELECT a AS doc_id, a AS low FROM links UNION SELECT b, low FROM reach JOIN links ON links.a = reach.doc_id AND low < b),
    lows AS (SELECT doc_id, min(low) AS low FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(low, doc_id) AS component_id, coalesce(low, doc_id) = doc_id AS kept
    FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN lows USING (doc_id)"""


def _substrings() -> str:
    w = substrings.WINDOW
    return f"""
    WITH texts AS (SELECT doc_id, {_words("text")} AS words FROM documents),
    spots AS (SELECT doc_id, words, unnest(range(1, len(words) - {w - 2})) AS i FROM texts WHERE len(words) >= {w}),
    windows AS (SELECT doc_id, i, md5(array_to_string(words[i:i + {w - 1}], ' ')) AS h FROM spots),
    again AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS low FROM windows) WHERE low < doc_id),
    gone AS (SELECT doc_id, list(DISTINCT i + d) AS spot FROM again, (SELECT unnest(range({w})) AS d) GROUP BY doc_id),
    kept AS (SELECT doc_id, words, coalesce(len(spot), 0) AS n_removed,
        list_filter(words, lambda x, i: NOT coalesce(list_contains(spot, i), false)) AS rest FROM texts LEFT JOIN gone USING (doc_id))
    SELECT doc_id, len(words)::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(rest, ' ')) AS kept_sha256 FROM kept"""


def _mixing() -> str:
    mix = mixing.Mix()
    goals = ", ".join(
        f"""own_{n} AS (SELECT {n} AS v, sum(tokens) AS own, pow(sum(tokens) / greatest(any_value(t), 1), {mix.temper[n]}) AS raw FROM cells, total GROUP BY {n}),
        fill_{n} AS (
            SELECT own, raw, own / nullif(raw, 0) AS ratio, ({mix.share} * t - coalesce(sum(own) OVER before, 0)) / nullif(sum(raw) OVER rest, 0) AS scale FROM own_{n}, total
            WINDOW before AS (ORDER BY own / nullif(raw, 0), v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                rest AS (ORDER BY own / nullif(raw, 0), v ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        aim_{n} AS (SELECT v, least(own, raw * (SELECT scale FROM fill_{n} WHERE own >= raw * scale ORDER BY ratio LIMIT 1)) AS aim FROM own_{n})"""
        for n in mixing.DIMENSIONS
    )
    turns = "r WHERE round < {} OR worst > {}".format(mix.rounds, mix.tolerance)
    kept = "round, source, lang, topic, tokens, aim_source, aim_lang, aim_topic"
    for number, n in enumerate(mixing.DIMENSIONS, 1):
        off = "abs(factor - 1)" if number == 1 else "greatest(off, abs(factor - 1))"
        turns = f"""(SELECT {kept}, least(weight * factor, {mix.most_weight}) AS weight, {off} AS off FROM (
            SELECT *, coalesce(aim_{n} / nullif(sum(tokens * least(weight, 1.0)) OVER (PARTITION BY {n}), 0), 1.0) AS factor FROM {turns}))"""
    aims = " ".join(f"JOIN aim_{n} ON c.{n} IS NOT DISTINCT FROM aim_{n}.v" for n in mixing.DIMENSIONS)
    share = lambda other: f"100 * length(regexp_replace(t, '{other}', '', 'g'))"
    return f"""
    WITH RECURSIVE texts AS (SELECT doc_id, source, lang, coalesce(text, '') AS t, greatest(length(coalesce(text, '')), 1) AS size FROM documents),
    named AS (SELECT doc_id, source, lang, len({_words("t")}) AS tokens,
        CASE WHEN {share("[^|]+")} >= 2 * size THEN 'table' WHEN {share("[^#*$%&<>]+")} >= 5 * size THEN 'symbols'
        WHEN {share("[^A-Z]+")} >= 30 * size THEN 'capitals' WHEN size < 200 THEN 'short' ELSE 'prose' END AS topic FROM texts),
    cells AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM named GROUP BY ALL),
    total AS (SELECT sum(tokens) AS t FROM cells),
    {goals},
    r AS (
        SELECT 0 AS round, source, lang, topic, tokens, aim_source.aim AS aim_source, aim_lang.aim AS aim_lang, aim_topic.aim AS aim_topic,
            {mix.share}::DOUBLE AS weight, 1e9::DOUBLE AS worst FROM cells c {aims}
        UNION ALL
        SELECT round + 1, source, lang, topic, tokens, aim_source, aim_lang, aim_topic, weight, max(off) OVER () FROM {turns}),
    rates AS (SELECT source, lang, topic, least(weight, 1.0) AS rate FROM r WHERE round = (SELECT max(round) FROM r))
    SELECT doc_id, n.source, n.lang, n.topic, round(rate, 6) AS rate,
        ('0x' || substr(md5('{mix.salt}' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT / {float(1 << 48)!r} < rate AS sampled
    FROM named n JOIN rates r ON n.source IS NOT DISTINCT FROM r.source AND n.lang IS NOT DISTINCT FROM r.lang AND n.topic IS NOT DISTINCT FROM r.topic"""


def _decontamination() -> str:
    w, separator = decontamination.WINDOW, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
    WITH items AS (SELECT item_id, {_words(_lower("text"), separator)} AS words FROM benchmark WHERE item_id IS NOT NULL),
    starts AS (SELECT item_id, words, unnest(range(1, greatest(len(words) - {w - 1}, 1) + 1)) AS i FROM items WHERE len(words) > 0),
    phrases AS (SELECT DISTINCT item_id, least(len(words), {w}) AS size, array_to_string(words[i:i + {w - 1}], ' ') AS phrase FROM starts),
    sizes AS (SELECT DISTINCT size FROM phrases),
    texts AS (SELECT doc_id, {_words(_lower("text"), separator)} AS words FROM documents),
    spots AS (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM texts, sizes WHERE len(words) >= size),
    runs AS (SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS phrase FROM spots),
    met AS (SELECT doc_id, i, r.size, item_id FROM runs r JOIN phrases p ON r.phrase = p.phrase AND r.size = p.size),
    hit AS (SELECT doc_id, count(DISTINCT spot) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM met) GROUP BY doc_id),
    named AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM met GROUP BY doc_id)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
        sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
    FROM texts LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""


def _filter_audit() -> str:
    limits = filter_audit.Limits()
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_words("text")} AS words FROM documents),
    judged AS (SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    marks AS (
        SELECT part, (len(words) < {limits.least_words})::INT
            + 2 * (100 * len(list_distinct(words)) < {limits.distinct_percent} * len(words))::INT
            + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > {limits.capital_percent} * length(t))::INT
            + 8 * regexp_matches(t, '[#$%&*|]')::INT
            + 16 * (doc_id > min(doc_id) OVER (PARTITION BY t))::INT AS mask,
            coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
        FROM texts LEFT JOIN judged USING (doc_id)),
    cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marks GROUP BY ALL),
    sets AS (SELECT part, s, coalesce(sum(n) FILTER (mask & s = 0), 0) AS n, coalesce(sum(good) FILTER (mask & s = 0), 0) AS good,
        coalesce(sum(toxic) FILTER (mask & s = 0), 0) AS toxic FROM cells, (SELECT unnest(range(32)) AS s) GROUP BY ALL),
    bits AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
    orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS chain
        FROM bits a, bits b, bits c, bits d, bits e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
    stages AS (SELECT filter_order, step, chain[step] AS bit, list_sum(chain[1:step])::BIGINT AS s FROM orders, (SELECT unnest(range(1, 6)) AS step)),
    fails AS (SELECT part, bit, coalesce(sum(n) FILTER (mask & bit > 0), 0) AS failing, coalesce(sum(n) FILTER (mask = bit), 0) AS alone FROM cells, bits GROUP BY ALL),
    moved AS (SELECT x.part, filter_order, step, g.bit, y.n AS kept, x.n - y.n AS removed, x.good - y.good AS good_lost, x.toxic - y.toxic AS toxic_lost
        FROM stages g JOIN sets x ON x.s = g.s - g.bit JOIN sets y ON y.s = g.s AND y.part = x.part)
    SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, (failing - removed)::BIGINT AS redundant,
        alone::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
        (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
    FROM moved JOIN fails USING (part, bit)"""


def _hard_negatives() -> str:
    m = hard_negatives.Mining()
    return f"""
    WITH vectors AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
        FROM vectors a JOIN vectors c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {m.positives})
    SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND {m.least_percent} * positive_score <= 100 * score AND 100 * score <= {m.most_percent} * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= {m.negatives}"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secrets": _secrets(),
        "op2_host_rules": _host_rules(),
        "op3_near_duplicates": _near_duplicates(),
        "op5_substrings": _substrings(),
        "op7_mixing": _mixing(),
        "op10_decontamination": _decontamination(),
        "op11_filter_audit": _filter_audit(),
        "op13_hard_negatives": _hard_negatives(),
    }

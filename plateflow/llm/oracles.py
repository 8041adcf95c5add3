"""SQL twins of the operators that SQL can express, for another engine.

Left out are operators with hashes that engine lacks (2 of 10 need XXH64 or CRC-32), regular expression
rules with suppression, sums of powers that are bisected, and strings of bytes; brute-force tests cover
these.
"""

from __future__ import annotations

import math

from plateflow.llm import collocations, decontamination, line_dedup, quality_rules, substring_dedup

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_GAMMA = repr((1 + quality_rules.RELATIVE_ERROR) / (1 - quality_rules.RELATIVE_ERROR))
_LOG_GAMMA = repr(math.log(float(_GAMMA)))
_LOWEST = math.ceil(math.log(1e-6) / math.log(float(_GAMMA)))


def _ratio(name: str) -> str:
    top, below = quality_rules.RATIOS[name]
    return f"{top}::DOUBLE / greatest({below}, 1)"


def _quality() -> str:
    names = list(quality_rules.RATIOS)
    base_failed = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"
    rows = " UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS ratio,"
        f" ceil(ln(greatest({_ratio(name)}, 1e-6)) / {_LOG_GAMMA})::INT AS bucket"
        " FROM different"
        for name in names
    )
    value = f"CASE WHEN bucket <= {_LOWEST} THEN 0.0 ELSE pow({_GAMMA}, bucket) END"

    def level(alias: str, keys: str) -> str:
        return f"""
{alias} AS (
    SELECT {keys}{", " if keys else ""}ratio, any_value(docs) AS docs,
        min({value}) FILTER (upto >= 0.25 * docs) AS low, min({value}) FILTER (upto >= 0.75 * docs) AS high
    FROM (
        SELECT *, sum(n) OVER (PARTITION BY {keys}{", " if keys else ""}ratio ORDER BY bucket) AS upto,
            sum(n) OVER (PARTITION BY {keys}{", " if keys else ""}ratio) AS docs
        FROM (SELECT {keys}{", " if keys else ""}ratio, bucket, count(*) AS n FROM buckets GROUP BY ALL)
    ) GROUP BY {keys}{", " if keys else ""}ratio
)"""

    def enough(level: str) -> str:
        least = quality_rules.LEAST_SPREAD
        return f"({level}.docs >= {quality_rules.MIN_DOCS} AND {level}.high - {level}.low >= {least} * {level}.high)"

    edge = f"""CASE WHEN {enough("o")} THEN o.high + {quality_rules.FENCE} * (o.high - o.low)
            WHEN {enough("l")} THEN l.high + {quality_rules.FENCE} * (l.high - l.low)
            ELSE a.high + {quality_rules.FENCE} * greatest(a.high - a.low, {quality_rules.CORPUS_SPREAD} * a.high) END"""
    origin = f"CASE WHEN {enough('o')} THEN 'source' WHEN {enough('l')} THEN 'lang' ELSE 'corpus' END"
    picks = {"max": "edge", "from": "origin"}
    limits = ", ".join(
        f"max(CASE WHEN ratio = '{name}' THEN {column} END) AS {kind}_{name}"
        for kind, column in picks.items()
        for name in names
    )

    def allowed(name: str) -> str:
        top, below = quality_rules.RATIOS[name]
        units, share = quality_rules.TOLERANCE[name]
        limit = f"coalesce(max_{name}, 'inf'::DOUBLE) + {share}::DOUBLE"
        return f"{top} <= ({limit}) * greatest({below}, 1) + {units}"

    within = " AND ".join(map(allowed, names))
    return f"""
WITH split AS (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
        trim(coalesce(text, ''), {_SPACES}) AS inner_text
    FROM documents
),
worded AS (
    SELECT *, CASE WHEN inner_text = '' THEN [] ELSE string_split_regex(inner_text, '[\\x20\\x09-\\x0D]+') END AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM split
),
grams AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n
    FROM (
        SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS gram
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM worded WHERE len(words) >= 5)
    )
),
repeated AS (
    SELECT doc_id, sum(least(5, coalesce(i - before, 5))) AS n
    FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM grams WHERE n > 1)
    GROUP BY doc_id
),
counts AS (
    SELECT doc_id, lang, source, text, len(words)::BIGINT AS n_words,
        length(array_to_string(words, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
    FROM worded LEFT JOIN repeated USING (doc_id)
),
different AS (
    SELECT DISTINCT lang, source, text, n_words, word_chars, n_symbols, n_lines, n_dup_lines
    FROM counts WHERE NOT {base_failed}
),
buckets AS ({rows}),
{level("own", "lang, source").strip()},
{level("of_lang", "lang").strip()},
{level("of_all", "").strip()},
edges AS (
    SELECT o.lang, o.source, o.ratio, round({edge}, 6) AS edge, {origin} AS origin
    FROM own o JOIN of_lang l ON l.lang = o.lang AND l.ratio = o.ratio JOIN of_all a ON a.ratio = o.ratio
),
limits AS (SELECT lang, source, {limits} FROM edges GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {base_failed} AS base_failed,
    (NOT {base_failed} AND {within}) AS kept, {", ".join(f"{kind}_{name}" for kind in picks for name in names)}
FROM counts LEFT JOIN limits USING (lang, source)
"""


def _decontamination() -> str:
    def shingles(table: str, key: str) -> str:
        return f"""
    SELECT DISTINCT {key}, array_to_string(words[i:i + 4], ' ') AS shingle
    FROM (
        SELECT {key}, words, unnest(range(1, len(words) - 3)) AS i
        FROM (
            SELECT {key}, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda x: x <> '') AS words
            FROM {table}
        ) WHERE len(words) >= 5
    )"""

    return f"""
WITH items AS ({shingles("benchmark", "item_id")}),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM items GROUP BY item_id),
docs AS ({shingles("documents", "doc_id")}),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM docs JOIN items USING (shingle) GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM shared JOIN sizes USING (item_id)
WHERE n_shared / n_shingles >= {decontamination.THRESHOLD}
"""


def _substrings() -> str:
    return f"""
WITH cut AS (
    SELECT doc_id, i, units[i] AS unit
    FROM (SELECT doc_id, units, unnest(range(1, len(units) + 1)) AS i
          FROM (SELECT doc_id, regexp_extract_all(text,
              '[^.!?\\n]*?[\\p{{L}}\\p{{N}}]{{{substring_dedup.LONG_WORD},}}[.!?\\n]*|[^.!?\\n]*[.!?\\n]+|[^.!?\\n]+') AS units FROM documents))
),
placed AS (
    SELECT doc_id, i, sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY i) AS unit_end, length(unit) AS size,
        regexp_extract_all(lower(unit), '[\\p{{L}}\\p{{N}}]+') AS words
    FROM cut
),
numbered AS (
    SELECT doc_id, unit_end - size AS start, unit_end, len(words) AS n, array_to_string(words, ' ') AS norm,
        row_number() OVER (PARTITION BY doc_id ORDER BY i) AS unit
    FROM placed WHERE len(words) > 0
),
ranked AS (
    SELECT *, first_value(doc_id) OVER w AS first_doc, first_value(start) OVER w AS first_at
    FROM numbered WINDOW w AS (PARTITION BY norm ORDER BY doc_id, start)
),
later AS (
    SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS run
    FROM ranked WHERE doc_id > first_doc OR start > first_at
)
SELECT doc_id, min(start)::INT AS "start", max(unit_end)::INT AS "end", count(*)::INT AS n_units,
    sum(n)::INT AS n_words, arg_min(first_doc, unit) AS first_doc_id, arg_min(first_at, unit)::INT AS first_start
FROM later GROUP BY doc_id, run HAVING sum(n) >= {substring_dedup.MIN_WORDS}
"""


def _lines() -> str:
    seen = f"regexp_replace(coalesce(html, ''), '{line_dedup.UNSEEN}', chr(10), 'g')"
    broken = f"regexp_replace({seen}, '{line_dedup.BREAKS}', chr(10), 'g')"
    plain = f"regexp_replace({broken}, '{line_dedup.TAGS}', '', 'g')"
    trimmed = f"trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13))"
    return f"""
WITH cut AS (
    SELECT page_id, url, lower(regexp_extract(coalesce(url, ''), '{line_dedup.HOST}', 1)) AS host,
        list_filter(list_transform(string_split({plain}, chr(10)), lambda x: {trimmed}), lambda x: x <> '') AS lines
    FROM pages
),
totals AS (SELECT host, count(*) AS host_pages FROM cut WHERE host <> '' GROUP BY host),
often AS (
    SELECT host, list(line) AS boilerplate
    FROM (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM cut) GROUP BY ALL)
    JOIN totals USING (host)
    WHERE n > 1 AND host_pages >= {line_dedup.MIN_PAGES} AND n > {line_dedup.MAX_RATIO} * host_pages
    GROUP BY host
),
filtered AS (
    SELECT cut.*, coalesce(host_pages, 0) AS host_pages,
        list_filter(lines, lambda x: NOT coalesce(list_contains(boilerplate, x), false)) AS kept
    FROM cut LEFT JOIN totals USING (host) LEFT JOIN often USING (host)
)
SELECT page_id, url, host, host_pages, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(kept))::BIGINT AS n_dropped, array_to_string(kept, chr(10)) AS kept_text
FROM filtered
"""


def _chat() -> str:
    added = r"\### Assistant: </turn> ok"
    escaped = r"replace(replace({}, '\', '\\'), '<', '\<')"
    return rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '{added}'), (-7, 1, 'assistant', '{added}')
),
written AS (
    SELECT *, {escaped.format("text")} AS body, replace({escaped.format("role")}, '>', '\>') AS head FROM turns
),
laid AS (
    SELECT *, '<turn ' || head || '>' || chr(10) || body || chr(10) || '</turn>' || chr(10) AS whole FROM written
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, whole)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, whole) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length(whole))::BIGINT AS formatted_chars
FROM laid GROUP BY conv_id
"""


def _collocations() -> str:
    capitals, small = (f"{a}{''.join(chr(ord(a) + k) for k in range(1, 26))}" for a in "Aa")
    return f"""
WITH pieces AS (
    SELECT coalesce(lang, '{collocations.NO_LANGUAGE}') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''), '{capitals}', '{small}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
),
worded AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM pieces
),
placed AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded
),
grams AS (
    SELECT lang, array_to_string(words[i : i + size - 1], ' ') AS phrase, size
    FROM placed, (SELECT unnest(range(1, {collocations.LONGEST} + 1)) AS size) WHERE i + size - 1 <= len(words)
),
totals AS (SELECT lang, count(*) AS n FROM placed GROUP BY lang),
counted AS (
    SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {collocations.MIN_COUNT}
),
candidates AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS words FROM counted WHERE size > 1),
cuts AS (
    SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n,
        (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
    JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1 : k], ' ')
    JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[k + 1 :], ' ')
    JOIN totals t ON t.lang = c.lang
),
best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
whole AS (
    SELECT * FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM candidates q WHERE q.lang = b.lang AND length(q.phrase) > length(b.phrase)
            AND 100 * q.a >= 100 * b.a AND contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' ')
    )
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM whole
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= {collocations.TOP}
"""


def statements() -> dict[str, str]:
    """The SQL twins by query name."""
    return {
        "op1_quality_rules": _quality(),
        "op2_benchmark_decontamination": _decontamination(),
        "op3_substring_dedup": _substrings(),
        "op6_line_dedup": _lines(),
        "op8_chat_formatting": _chat(),
        "op12_phrase_collocations": _collocations(),
    }

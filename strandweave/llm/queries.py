"""The training-data operators as queries, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave.llm import decontaminate, licenses, packing, quality, quotes, repeats, secrets, simhash, url_reputation, warc
from strandweave.llm.common import LOWER, UPPER, table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = url_reputation.outcomes_of(table(spark, sf_dir, "labels"))
    return url_reputation.judge(table(spark, sf_dir, "pages"), outcomes)


def op5_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(spark, sf_dir, "pages"))).drop("payload")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scan(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op8_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.build(table(spark, sf_dir, "conversations"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_benchmark_decontamination,
        op3_substring_dedup,
        op4_url_filter,
        op5_warc_bundles,
        op6_quality_rules,
        op7_simhash,
        op8_quote_linking,
        op9_secret_scan,
        op10_best_fit_packing,
    )
}


def _words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _op1() -> str:
    phrases = ",\n".join(
        f"('{label}', {str(base).lower()}, {_list(terms)}, {_list(template)}, {at})"
        for _, label, base, terms, template, at in licenses.phrase_rows()
    )
    return f"""
WITH p(label, base, terms, template, key_at) AS (VALUES {phrases}),
d AS (SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents),
t AS (SELECT r, doc_id, w, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
h AS (
  SELECT r, label, base, i,
    len(list_filter(range(len(template)), lambda j: i - key_at + j >= 0 AND w[i - key_at + j + 1] = template[j + 1]))::DOUBLE
      / len(template) AS share
  FROM t JOIN p ON t.word = p.terms[1] WHERE w[i + 1 : i + len(terms)] = terms
),
g AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(i) FILTER (base) AS first_word, max(i) FILTER (base) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label) FILTER (base OR share >= {licenses.MIN_SHARE})), ',') AS labels,
    max(share) FILTER (base OR share >= {licenses.MIN_SHARE}) AS score
  FROM h GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN g USING (r)"""


def _op2() -> str:
    return f"""
WITH b AS (SELECT item_id::VARCHAR AS item, {_words("text")} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, w[s + 1 : s + {decontaminate.WINDOW}] AS terms
  FROM (SELECT item, w, unnest(range(greatest(len(w) - {decontaminate.WINDOW - 1}, 1))) AS s FROM b WHERE len(w) > 0)
),
d AS (SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents),
t AS (SELECT r, w, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
h AS (SELECT DISTINCT r, i, len(terms) AS n, item FROM t JOIN win ON t.word = win.terms[1] WHERE w[i + 1 : i + len(terms)] = terms),
c AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT r, i, unnest(range(n)) AS k FROM h) GROUP BY r),
g AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM h GROUP BY r),
tc AS (SELECT word, count(*) AS n FROM t GROUP BY word),
pw AS (SELECT row_number() OVER () AS p, terms FROM (SELECT DISTINCT terms FROM win)),
pt AS (SELECT p, word, pos, n, row_number() OVER (PARTITION BY p ORDER BY n, pos) AS k, count(n) OVER (PARTITION BY p) = len(terms) AS held
  FROM (SELECT p, terms, unnest(terms) AS word, unnest(range(len(terms))) AS pos FROM pw) LEFT JOIN tc USING (word)),
pa AS (SELECT p, max(word) FILTER (k = 1) AS w1, max(word) FILTER (k = 2) AS w2, max(word) FILTER (k = 3) AS w3 FROM pt WHERE held GROUP BY p),
pn AS (
  SELECT DISTINCT p, x.r FROM (SELECT * FROM pa WHERE w3 IS NOT NULL) JOIN t x ON x.word = w1
  JOIN t y ON y.word = w2 AND y.r = x.r AND abs(y.i - x.i) <= {decontaminate.NEAR} JOIN t z ON z.word = w3 AND z.r = x.r AND abs(z.i - x.i) <= {decontaminate.NEAR}
),
ni AS (SELECT r, count(DISTINCT item) AS n_near FROM (
  SELECT r, item FROM pn JOIN pw USING (p) JOIN win ON win.terms = pw.terms UNION SELECT r, item FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(n_near, 0)::BIGINT AS n_near_items
FROM d LEFT JOIN c USING (r) LEFT JOIN g USING (r) LEFT JOIN ni USING (r)"""


def _op3() -> str:
    n = repeats.WINDOW
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY terms ORDER BY doc_id, i) > 1 AS again
  FROM (SELECT doc_id, i, array_to_string(w[i + 1 : i + {n}], ' ') AS terms
    FROM (SELECT doc_id, w, unnest(range(len(w) - {n - 1})) AS i FROM d WHERE len(w) >= {n}))
),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM (SELECT doc_id, i, unnest(range({n})) AS k FROM win WHERE again)),
t AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
g AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN g USING (doc_id)"""


def _op4() -> str:
    rules = sorted(url_reputation.RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    cases = lambda what: " ".join(
        f"WHEN (host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p if what == 'rule' else v}'" for v, h, p in rules
    )
    low, high = url_reputation.STRENGTH
    strength = lambda t: f"""(SELECT coalesce(least(greatest(CASE WHEN n > 0 AND between_groups > 1e-9 THEN m * (1 - m) / between_groups - 1 ELSE {high} END, {low}), {high}), {high})
    FROM (SELECT n, m, spread - m * m - m * (1 - m) * groups / n AS between_groups FROM (
      SELECT sum(n)::DOUBLE AS n, sum(bad) / sum(n)::DOUBLE AS m, count(*) FILTER (n > 0) AS groups,
        sum(bad::DOUBLE * bad / n) FILTER (n > 0) / sum(n) AS spread FROM {t})))"""  # noqa: E731
    address, x = r"regexp_matches({0}, '^[0-9.]*[0-9]$|^\[')", url_reputation.MAX_BAD
    return rf"""
WITH RECURSIVE lab AS (
  SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL AND (toxic = 1 OR quality = 0) IS NOT NULL GROUP BY doc_id
),
pg AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
),
hosts AS (
  SELECT *, CASE WHEN {address.format("domain")} THEN '{url_reputation.ADDRESS}' WHEN domain LIKE '%.%' THEN regexp_replace(domain, '^[^.]*\.', '') ELSE domain END AS suffix FROM (
    SELECT *, CASE WHEN {address.format("name")} THEN name WHEN regexp_matches(array_to_string(parts[-2:], '.'), '^({url_reputation.SECOND_LEVEL})\.[a-z]{{2}}$')
      THEN array_to_string(parts[-3:], '.') ELSE array_to_string(parts[-2:], '.') END AS domain
    FROM (SELECT *, string_split(name, '.') AS parts FROM (SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), '(:[0-9]*|\.)$', '') AS name,
      count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM pg LEFT JOIN lab USING (page_id) GROUP BY host)))
),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
sr AS (SELECT suffix, (bad + s * (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1) FROM suffixes)) / (n + s) AS rate
  FROM suffixes, (SELECT {strength("suffixes")} AS s)),
dr AS (SELECT domain, (bad + s * sr.rate) / (n + s) AS rate FROM domains JOIN sr USING (suffix), (SELECT {strength("domains")} AS s)),
hr AS (SELECT host, (bad + s * dr.rate) / (n + s) AS rate, bad + s * dr.rate AS a, n - bad + s * (1 - dr.rate) AS b
  FROM hosts JOIN dr USING (domain), (SELECT {strength("hosts")} AS s)),
side AS (SELECT host, rate, {x} < (a + 1) / (a + b + 2) AS low, CASE WHEN {x} < (a + 1) / (a + b + 2) THEN a ELSE b END AS a,
  CASE WHEN {x} < (a + 1) / (a + b + 2) THEN b ELSE a END AS b, CASE WHEN {x} < (a + 1) / (a + b + 2) THEN {x} ELSE 1 - {x} END AS x FROM hr),
cf AS (
  SELECT host, 0 AS k, 1e300::DOUBLE AS c, 1::DOUBLE AS d, 1::DOUBLE AS h, a, b, x FROM side
  UNION ALL SELECT host, k + 1, 1 + e / c, 1 / (1 + e * d), h * (1 + e / c) / (1 + e * d), a, b, x FROM (
    SELECT *, CASE WHEN k % 2 = 1 THEN (k + 1) // 2 * (b - (k + 1) // 2) ELSE -(a + k // 2) * (a + b + k // 2) END * x / ((a + k) * (a + k + 1)) AS e
    FROM cf WHERE k < floor(100 + 3 * sqrt(a + b)))
),
tail AS (SELECT host, low, rate, exp(a * ln(x) + b * ln(1 - x) - lgamma(a) - lgamma(b) + lgamma(a + b)) / a * h AS p
  FROM side JOIN (SELECT host, arg_max(h, k) AS h FROM cf GROUP BY host) USING (host)),
rep AS (SELECT host, round(rate, 6) AS bad_rate, round(CASE WHEN low THEN 1 - p ELSE p END, 6) AS p_bad FROM tail)
SELECT page_id, host, path, CASE {cases("rule")} END AS rule,
  CASE {cases("verdict")} WHEN p_bad > {url_reputation.SURE} THEN 'block' ELSE 'allow' END AS verdict, bad_rate, p_bad
FROM pg JOIN rep USING (host)"""


def _op5() -> str:
    return """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) || '0' AS h FROM pages),
l AS (SELECT html, max(page_id) AS last FROM p GROUP BY html)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + ((('0x' || substr(h, (5 * k) // 4 + 1, 2))::INT >> (3 - (5 * k) % 4)::INT) & 31))::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM p JOIN l USING (html)"""


def _op8() -> str:
    return r"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS r, conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) AS lines FROM conversations
),
l AS (SELECT r, conv_id, turn, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM m),
x AS (
  SELECT r, conv_id, turn, i, len(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)*'), '[^>]', '', 'g')) AS level,
    regexp_replace(line, '^(?:[ \t]*>)*[ \t]?', '') AS content,
    trim(regexp_replace(translate(regexp_replace(line, '^(?:[ \t]*>)*', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20]+', ' ', 'g'), ' ') AS plain
  FROM l
),
s AS (
  SELECT DISTINCT r, conv_id, turn, level, plain AS passage FROM x WHERE len(string_split(plain, ' ')) >= 3
  UNION SELECT r, conv_id, turn, level, plain || chr(10) || next FROM (SELECT *, lead(plain) OVER (PARTITION BY r, level ORDER BY i) AS next FROM x WHERE plain != '') WHERE next IS NOT NULL
  UNION SELECT r, conv_id, turn, level, string_agg(plain, ' ' ORDER BY i) FROM x WHERE plain != '' GROUP BY r, conv_id, turn, level
),
said AS (SELECT conv_id, passage, min(turn) AS origin FROM s WHERE level = 0 AND turn IS NOT NULL GROUP BY conv_id, passage),
q AS (
  SELECT a.conv_id, a.turn, level, origin, sum(len(passage)) AS matched, count(*) AS n
  FROM (SELECT DISTINCT conv_id, turn, level, passage FROM s WHERE level > 0) a JOIN said USING (conv_id, passage) WHERE origin < a.turn
  GROUP BY a.conv_id, a.turn, level, origin
),
k AS (SELECT conv_id, turn, arg_max(origin, (-level, matched, origin)) AS reply_to, sum(n) AS passages FROM q GROUP BY conv_id, turn),
up AS (
  SELECT conv_id, turn, reply_to AS thread, 1 AS depth FROM k
  UNION ALL SELECT up.conv_id, up.turn, k.reply_to, depth + 1 FROM up JOIN k ON up.conv_id = k.conv_id AND up.thread = k.turn
),
th AS (SELECT conv_id, turn, arg_max(thread, depth) AS thread, max(depth) AS depth FROM up GROUP BY conv_id, turn),
own AS (
  SELECT r, string_agg(content, chr(10) ORDER BY i) FILTER (level = 0) AS text, count(*) FILTER (level > 0) AS n_quoted_lines FROM x GROUP BY r
)
SELECT m.conv_id, coalesce(th.thread, m.turn) AS thread, m.turn, coalesce(depth, 0)::BIGINT AS depth, reply_to, role,
  trim(coalesce(own.text, ''), ' ') AS text, n_quoted_lines::BIGINT AS n_quoted_lines, coalesce(passages, 0)::BIGINT AS n_linked
FROM m JOIN own USING (r) LEFT JOIN k ON m.conv_id = k.conv_id AND m.turn = k.turn LEFT JOIN th ON m.conv_id = th.conv_id AND m.turn = th.turn"""


def _op9() -> str:
    low, wide, n = secrets.LOW, secrets.WIDTH, secrets.SAMPLES
    case = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    keys = "|".join(case(k) for k in ("password", "passwd", "secret", "token", "api_?key"))
    assign = rf"""(?:{keys})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""".replace("'", "''")
    # pieces between the matches tell where these lie
    spans = lambda kind, order, pattern, rest, of="d": f"""SELECT r, {order} AS o, '{kind}' AS kind, hits[i] AS hit,
      list_sum(list_transform(pieces[1 : i], lambda x: len(x))) + coalesce(list_sum(list_transform(hits[1 : i - 1], lambda x: len(x))), 0) AS s
      FROM (SELECT r, hits, pieces, unnest(range(1, len(hits) + 1)) AS i FROM (
        SELECT r, regexp_extract_all(text, '{pattern}') AS hits, regexp_split_to_array(text, '{pattern}') AS pieces FROM {of} WHERE regexp_matches(text, '{pattern}')))
      WHERE {rest}"""  # noqa: E731
    blanked = lambda of, pattern, rest: f"""SELECT r, CASE WHEN regexp_matches(text, '{pattern}') THEN array_to_string(list_transform(range(1, len(pieces) + 1),
      lambda i: pieces[i] || coalesce(CASE WHEN {rest} THEN repeat(' ', len(hits[i])) ELSE hits[i] END, '')), '') ELSE text END AS text
      FROM (SELECT r, text, regexp_extract_all(text, '{pattern}') AS hits, regexp_split_to_array(text, '{pattern}') AS pieces FROM {of})"""  # noqa: E731
    long_value = f"len(regexp_extract(hits[i], '{assign}', 1)) >= {secrets.LEAST_VALUE}"
    parts = _list(secrets.PARTS)
    part = lambda k: f"({parts})[('0x' || substr(h, {k}, 4))::INT % {len(secrets.PARTS)} + 1]"
    title = lambda x: f"(upper(substr({x}, 1, 1)) || substr({x}, 2))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
base AS (SELECT r, o, kind, hit, s, s + len(hit) AS e FROM (
  {spans("assign", 0, assign, long_value)}
  UNION ALL {spans("access", 1, secrets.ACCESS, "true")}
  UNION ALL {spans("hex", 2, secrets.HEX, "true")})),
n AS (SELECT i, sha256(i::VARCHAR) AS h FROM range({n}) t(i)),
m AS (SELECT i, h, rtrim(to_base64(unhex(h)), '=') AS b, {part(1)} AS a1, {part(5)} AS a2, {part(9)} AS a3, {part(13)} AS a4, ('0x' || substr(h, 60, 2))::INT AS k FROM n),
sample AS (
  SELECT true AS random, CASE i % 6 WHEN 0 THEN b WHEN 1 THEN substr(h, 1, 40) WHEN 2 THEN translate(b, '+/', '-_') WHEN 3 THEN upper(substr(regexp_replace(b, '[+/]', '', 'g'), 1, 24))
    WHEN 4 THEN substr(regexp_replace(b, '[+/]', '', 'g'), 1, 16 + k % 8) ELSE substr(regexp_replace(b, '[+/0-9]', '', 'g'), 1, 20) END AS x FROM m
  UNION ALL SELECT false, CASE i % 6 WHEN 0 THEN a1 || '_' || a2 || '_' || a3 || '_' || k WHEN 1 THEN a1 || '-' || a2 || '-' || a3 || '-' || a4 || '-' || (1990 + k % 40)
    WHEN 2 THEN a1 || {title("a2")} || {title("a3")} || {title("a4")} || k WHEN 3 THEN a1 || '/' || (1990 + k % 40) || '/' || printf('%02d', k % 12 + 1) || '/' || a2 || '/' || a3
    WHEN 4 THEN upper(a1) || '_' || upper(a2) || '_' || upper(a3) || '_' || printf('%02d', k % 12 + 1) ELSE a1 || '-' || (1990 + k % 40) || '-' || printf('%02d', k % 12 + 1) || '-' || a2 || '=' || a3 END FROM m
),
pair AS (SELECT random, ascii(substr(x, j, 1)) - {low} AS a, ascii(substr(x, j + 1, 1)) - {low} AS b, count(*) AS c FROM (SELECT random, x, unnest(range(1, len(x))) AS j FROM sample) GROUP BY ALL),
total AS (SELECT random, a, sum(c) AS c FROM pair GROUP BY random, a),
ch AS (SELECT unnest(range({wide})) AS a), cell AS (SELECT x.a, y.a AS b FROM ch x, ch y),
model AS (
  SELECT cell.a, cell.b, round(ln(((coalesce(p1.c, 0) + {secrets.SMOOTHING}) / (coalesce(t1.c, 0) + {secrets.SMOOTHING * wide})) / ((coalesce(p0.c, 0) + {secrets.SMOOTHING}) / (coalesce(t0.c, 0) + {secrets.SMOOTHING * wide}))), 5) AS llr
  FROM cell LEFT JOIN pair p1 ON p1.random AND p1.a = cell.a AND p1.b = cell.b LEFT JOIN pair p0 ON NOT p0.random AND p0.a = cell.a AND p0.b = cell.b
    LEFT JOIN total t1 ON t1.random AND t1.a = cell.a LEFT JOIN total t0 ON NOT t0.random AND t0.a = cell.a
),
d1 AS ({blanked("d", assign, long_value)}), d2 AS ({blanked("d1", secrets.ACCESS, "true")}), d3 AS ({blanked("d2", secrets.HEX, "true")}),
free AS (SELECT r, o, kind, hit, s, s + len(hit) AS e FROM ({spans("markov", 3, secrets.RUN, f"regexp_matches(hits[i], '{secrets.ODD}')", "d3")})),
judged AS (
  SELECT f.r, f.s, f.e, avg(llr) AS ratio FROM (SELECT *, unnest(range(1, len(hit))) AS j FROM free) f
  JOIN model ON model.a = ascii(substr(hit, j, 1)) - {low} AND model.b = ascii(substr(hit, j + 1, 1)) - {low} GROUP BY f.r, f.s, f.e
),
found AS (SELECT r, o, kind, s, e FROM base UNION ALL SELECT r, 3, 'markov', s, e FROM judged WHERE ratio > {secrets.LEAST_RATIO}),
g AS (
  SELECT r, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (o < 3) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans FROM found GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": _op1(),
        "op2_benchmark_decontamination": _op2(),
        "op3_substring_dedup": _op3(),
        "op4_url_filter": _op4(),
        "op5_warc_bundles": _op5(),
        "op8_quote_linking": _op8(),
        "op9_secret_scan": _op9(),
    }

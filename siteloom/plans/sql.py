"""The steps as SQL text, an independent statement of what the queries return."""

from __future__ import annotations

from ..functions import pages, topics, urls
from ..sources import IMPRESSIONS_SQL
from .fixtures import NAMES

NOW = "TIMESTAMP '2024-02-01 00:00:00'"
WINDOW = "date >= DATE '2024-01-05' AND date < DATE '2024-01-15'"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(map(q, values))


def cte(**steps: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in steps.items()) + "\n"


def extract(where: str = "TRUE") -> str:
    return f"""SELECT site, trimmed_page_url, client_id, url_hash, access_hits FROM (
      SELECT *, count(*) OVER (PARTITION BY url_hash) AS access_hits, row_number() OVER (PARTITION BY url_hash ORDER BY site IN ({listed(urls.PLACEHOLDERS)}), site, client_id) AS rn
      FROM (SELECT lower(trim(site)) AS site, lower(trim(trimmed_page_url)) AS trimmed_page_url, client_id, sha256(lower(trim(trimmed_page_url))) AS url_hash
            FROM imp WHERE site IS NOT NULL AND trimmed_page_url IS NOT NULL AND client_id NOT LIKE '%Demo%' AND ({where}))) WHERE rn = 1"""


HOSTS = f"""SELECT *, regexp_extract(host, '\\.([^.]+)$', 1) AS tld FROM (
  SELECT *, regexp_replace(netloc, '^www\\.', '') AS host FROM (
    SELECT *, CASE WHEN regexp_matches(u0, '[.:]') THEN u0 ELSE s0 END AS netloc FROM (
      SELECT *, split_part(regexp_replace(trimmed_page_url, '^https?://', ''), '/', 1) AS u0, split_part(regexp_replace(site, '^https?://', ''), '/', 1) AS s0
      FROM ext WHERE trimmed_page_url NOT IN ({listed(urls.PLACEHOLDERS)}) AND site NOT IN ({listed(urls.PLACEHOLDERS)}))))"""
REASONS = f"""SELECT * EXCLUDE (u0, s0), CASE
  WHEN tld IN ({listed(urls.RESERVED)}) OR regexp_matches(host, {q(urls.LOCAL)}) THEN 'reserved_or_local'
  WHEN regexp_matches(host, {q(urls.INTERNAL_SUFFIX)}) THEN 'internal_suffix'
  WHEN regexp_matches(host, {q(urls.INTERNAL_PATTERN)}) THEN 'internal_pattern'
  WHEN NOT contains(host, '.') THEN 'single_label_host'
  WHEN regexp_matches(host, {q(urls.IPV4)}) THEN 'ipv4_literal'
  WHEN regexp_matches(netloc, {q(urls.PORT)}) THEN 'explicit_port'
  WHEN contains(host, '_') THEN 'underscore_in_host' END AS drop_reason FROM hosts"""
VALID = """SELECT * EXCLUDE (drop_reason), CASE WHEN starts_with(trimmed_page_url, 'http') THEN trimmed_page_url
  WHEN starts_with(trimmed_page_url, '//') THEN 'https:' || trimmed_page_url
  WHEN starts_with(trimmed_page_url, '/') THEN 'https://' || host || trimmed_page_url
  ELSE 'https://' || trimmed_page_url END AS page_url FROM reasons WHERE drop_reason IS NULL"""
BODIES = "SELECT page_id, lower(trim(regexp_replace(url, '^https?://', ''))) AS bare, sha256(lower(trim(regexp_replace(url, '^https?://', '')))) AS url_hash, html FROM pages"


def map_topic(topic: str) -> str:
    return "CASE " + " ".join(f"WHEN starts_with({topic}, {q(p)}) THEN {q(label)}" for p, label in topics.RULES) + f" ELSE {q(topics.OTHER)} END"


def name(k: int) -> str:
    return f"[{listed(NAMES)}][(page_id + {k}) % {len(NAMES)} + 1]"


def sure(k: int) -> str:
    return f"(((page_id * 37 + {k}) % 101) / 100.0::DOUBLE)"


SEED = f"""SELECT url_hash, TIMESTAMP '2024-01-01 00:00:00' AS created_at, bare AS trimmed_page_url, split_part(bare, '/', 1) AS site, 'https://' || bare AS page_url,
  CASE WHEN page_id % 3 = 0 THEN {map_topic(name(0))} END AS business_category, CASE WHEN page_id % 3 = 0 THEN {name(0)} END AS content_topic,
  CASE WHEN page_id % 3 = 0 THEN {sure(0)} END AS prediction_confidence, CASE WHEN page_id % 3 = 0 THEN {sure(0)} < 0.6 END AS review_flag,
  CAST(NULL AS VARCHAR) AS nlp_raw_categories, 'client_0' AS client_id, TIMESTAMP '2024-01-01 00:00:00' AS last_accessed, 1::BIGINT AS view_count
  FROM bodies WHERE page_id % 3 < 2"""
KEYS = "SELECT DISTINCT url_hash FROM seed WHERE content_topic IS NOT NULL"
COUNTED = "SELECT v.*, d.dup_hits FROM valid v LEFT JOIN (SELECT url_hash, count(*) AS dup_hits FROM valid GROUP BY url_hash) d USING (url_hash)"
FRESH = "SELECT * FROM counted c WHERE NOT EXISTS (SELECT 1 FROM keys k WHERE k.url_hash = c.url_hash)"
TOUCHES = "SELECT DISTINCT url_hash, dup_hits FROM counted c WHERE EXISTS (SELECT 1 FROM keys k WHERE k.url_hash = c.url_hash)"


def batched(size: int, run_id: str = "run") -> str:
    return f"SELECT *, {q(run_id)} AS run_id, ('batch_' || batch_index || '_{run_id}') AS batch_id FROM (SELECT *, CAST((row_number() OVER (ORDER BY url_hash) - 1) // {size} AS BIGINT) AS batch_index FROM fresh)"


#: The character references that the pages have.
ENTITIES = (("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", "\xa0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def is_html(body: str) -> str:
    return f"regexp_matches(lower(substring({body}, 1, {pages.SNIFFED})), {q('|'.join(pages.HTML_MARKS))})"


def visible(body: str) -> str:
    bare = f"regexp_replace(regexp_replace({body}, {q(pages.UNSEEN)}, chr(1), 'g'), {q(pages.TAG)}, chr(1), 'g')"
    node = "x"
    for a, b in ENTITIES:
        node = f"replace({node}, {q(a)}, {q(b)})"
    return f"CASE WHEN {is_html(body)} AND NOT starts_with({body}, '[ERROR') THEN array_to_string(list_filter(list_transform(string_split({bare}, chr(1)), lambda x: regexp_replace({node}, {q(f'^{pages.SPACE}+|{pages.SPACE}+$')}, '', 'g')), lambda x: x <> ''), ' ') ELSE '' END"


def n_words(text: str) -> str:
    return f"len(list_filter(regexp_split_to_array(coalesce({text}, ''), {q(pages.SPACE + '+')}), lambda x: x <> ''))"


TEXTS = f"SELECT * EXCLUDE (body), {visible('body')} AS page_text FROM (SELECT b.*, p.page_id, CASE WHEN p.html IS NULL THEN '[ERROR] All methods failed' WHEN p.page_id % 19 = 0 THEN '[SKIP:404]' ELSE p.html END AS body FROM batched b LEFT JOIN bodies p USING (url_hash))"
HOME = "(trimmed_page_url <> '' AND site <> '' AND rtrim(lower(trim(trimmed_page_url)), '/') = replace(lower(trim(site)), 'www.', ''))"
CLASSIFIED = f"""SELECT url_hash, {NOW} AS created_at, trimmed_page_url, site, page_url, CASE WHEN {HOME} THEN {q(topics.HOME)} ELSE {map_topic(name(0))} END AS business_category,
  {name(0)} AS content_topic, {sure(0)} AS prediction_confidence, {sure(0)} < 0.6 AS review_flag,
  {name(0)} || '=' || printf('%.2f', {sure(0)}) || CASE WHEN page_id % 2 = 0 THEN '; ' || {name(3)} || '=' || printf('%.2f', {sure(3)}) ELSE '' END AS nlp_raw_categories,
  client_id, {NOW} AS last_accessed, greatest(access_hits, 1)::BIGINT AS view_count
  FROM texts WHERE page_id % 17 <> 0 AND page_id % 13 <> 0 AND {n_words('page_text')} >= {topics.LEAST_WORDS}"""
TOUCHED = f"SELECT t.* REPLACE (CASE WHEN s.url_hash IS NULL THEN t.last_accessed ELSE {NOW} END AS last_accessed) FROM seed t LEFT JOIN touches s USING (url_hash)"


def best(target: str, source: str) -> str:
    take = lambda c: f"CASE WHEN t.url_hash IS NULL THEN s.{c} WHEN s.prediction_confidence > t.prediction_confidence THEN s.{c} ELSE t.{c} END AS {c}"
    keep = lambda c: f"CASE WHEN t.url_hash IS NULL THEN s.{c} ELSE t.{c} END AS {c}"
    conf = "CASE WHEN t.url_hash IS NULL THEN s.prediction_confidence WHEN s.url_hash IS NULL THEN t.prediction_confidence ELSE greatest(coalesce(t.prediction_confidence, 0), coalesce(s.prediction_confidence, 0)) END AS prediction_confidence"
    return f"""SELECT coalesce(t.url_hash, s.url_hash) AS url_hash, {keep('created_at')}, {keep('trimmed_page_url')}, {keep('site')}, {keep('page_url')}, {take('business_category')}, {take('content_topic')}, {conf},
      {take('review_flag')}, {take('nlp_raw_categories')}, {keep('client_id')}, CASE WHEN s.url_hash IS NULL THEN t.last_accessed ELSE {NOW} END AS last_accessed, {keep('view_count')}
      FROM {target} t FULL JOIN (SELECT * FROM {source} WHERE content_topic IS NOT NULL AND prediction_confidence IS NOT NULL AND NOT isnan(prediction_confidence)) s ON t.url_hash = s.url_hash"""


LIFETIME = "SELECT sha256(lower(trim(trimmed_page_url))) AS url_hash, count(*) AS lifetime_hits FROM imp WHERE site IS NOT NULL AND trimmed_page_url IS NOT NULL AND client_id NOT LIKE '%Demo%' GROUP BY 1"


def reconciled(target: str, keys: str) -> str:
    return f"""SELECT t.* REPLACE (coalesce(h.lifetime_hits, t.view_count) AS view_count, CASE WHEN h.url_hash IS NULL THEN t.last_accessed ELSE {NOW} END AS last_accessed)
      FROM {target} t LEFT JOIN (SELECT * FROM life WHERE url_hash IN (SELECT url_hash FROM {keys})) h ON t.url_hash = h.url_hash"""


BASE = {"imp": IMPRESSIONS_SQL.strip(), "bodies": BODIES, "seed": SEED, "keys": KEYS}


def chain(where: str = WINDOW, size: int = 100, **more: str) -> str:
    """All steps up to classified rows, then more."""
    base = BASE | {k: more.pop(k) for k in list(more) if k in BASE}
    return cte(**base, ext=extract(where), hosts=HOSTS, reasons=REASONS, valid=VALID, counted=COUNTED, fresh=FRESH, touches=TOUCHES, batched=batched(size), texts=TEXTS, classified=CLASSIFIED, touched=TOUCHED, life=LIFETIME, **more)

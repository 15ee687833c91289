"""SQL twins of the queries that SQL can express."""


def urls(rules: tuple[tuple[str, str], ...], blocked: tuple[str, ...]) -> str:
    def fits(text: str) -> str:
        domain, _, rest = text.partition("/")
        return f"((host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '/{rest}'))"

    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    rule = "CASE " + " ".join(f"WHEN {fits(text)} THEN '{text}'" for _, text in ordered) + " END"
    action = "CASE rule " + " ".join(f"WHEN '{text}' THEN '{verb}'" for verb, text in ordered)
    listed = " OR ".join(f"host = '{key}' OR ends_with(host, '.{key}')" for key in blocked)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), judged AS (SELECT *, {rule} AS rule, ({listed}) AS listed FROM parsed)
SELECT page_id, host, path, rule, {action} ELSE CASE WHEN listed THEN 'block' ELSE 'allow' END END AS verdict, listed
FROM judged"""


REVISITS = r"""
WITH split AS (
  SELECT *, regexp_replace(regexp_replace(url, '(?s)^[A-Za-z][A-Za-z0-9+.-]*://', ''), '(?s)#.*', '') AS rest FROM pages
), parts AS (
  SELECT page_id, coalesce(html, '') AS html, rest,
         regexp_replace(lower(regexp_extract(rest, '(?s)^([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g') AS host,
         regexp_replace(regexp_extract(rest, '(?s)^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(rest, '(?s)^[^?]*\?(.*)$', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS query
  FROM split
), pages2 AS (
  SELECT page_id, CASE WHEN rest IS NULL THEN NULL ELSE host || path || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END END AS url,
         md5(html) AS digest, length(html) AS size, page_id * 10 AS first, page_id * 10 + 5 + (page_id % 3) * 1000 AS again
  FROM parts
), records AS (
  SELECT page_id, url, first AS ts, 1 AS is_full, digest, size, 'd' || (page_id % 1000) AS day,
         CASE WHEN page_id % 4 <> 3 THEN '"' || digest || '"' END AS tag FROM pages2 WHERE page_id % 6 <> 5
  UNION ALL
  SELECT page_id, url, again, 0, NULL, NULL, 'd' || (page_id % 1000),
         CASE WHEN page_id % 5 = 0 THEN '"other"' WHEN page_id % 4 <> 3 THEN 'W/"' || digest || '"' END FROM pages2
), looked AS (
  SELECT *, CASE WHEN url IS NOT NULL THEN last_value(CASE WHEN is_full = 1
    THEN {'id': page_id, 'ts': ts, 'digest': digest, 'size': size, 'day': day, 'tag': tag} END IGNORE NULLS) OVER (
    PARTITION BY url ORDER BY ts, is_full, page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS f
  FROM records
), judged AS (
  SELECT *, CASE WHEN f IS NULL THEN 'no earlier response'
    WHEN coalesce(regexp_replace(tag, '^W/', '') = regexp_replace(f.tag, '^W/', ''), day = f.day, false) THEN 'resolved'
    ELSE 'validators differ' END AS status
  FROM looked WHERE is_full = 0
)
SELECT page_id AS record_id, url AS canonical_url, ts, status,
       CASE WHEN status = 'resolved' THEN f.id END AS refers_to,
       CASE WHEN status = 'resolved' THEN f.digest END AS payload_digest,
       'cache-control=max-age=60; content-length=' || CASE WHEN status = 'resolved' THEN f.size::VARCHAR || '; content-type=text/html' ELSE '0' END
       || '; date=t' || ts
       || CASE WHEN status = 'resolved' THEN coalesce('; etag=' || coalesce(tag, f.tag), '') ELSE coalesce('; etag=' || tag, '') END
       || '; expires=t' || (ts + 3600)
       || '; last-modified=' || CASE WHEN status = 'resolved' THEN f.day ELSE day END AS headers
FROM judged"""

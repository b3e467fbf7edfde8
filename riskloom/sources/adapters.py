"""Domain relations as projections of the driver's tables.

Each view is one SELECT that Spark and DuckDB both run, so queries and their SQL read the same rows. Only what EXACT names is
summed otherwise in Spark: a sum of doubles depends on the order of its rows, and where it is rounded down, so does the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "orders", "lineitem", "part", "supplier", "nation", "events", "pages")

_TLD = "case k % 5 when 0 then 'com' when 1 then 'xyz' when 2 then 'top' when 3 then 'org' else 'net' end"
_HUB = f"""select k as sec_domain_id,
  lower(c_mktsegment) || '-' || cast(k as string) || '.' || {_TLD} as sec_domain,
  case when k % 17 = 0 then null else lower(c_mktsegment) || '-' || cast(k as string) || '.' || {_TLD} end as sec_domain_root,
  case k % 4 when 1 then 'Ad Sniffer' when 2 then 'Domain Telemetry' else 'SimilarWeb' end as sec_domain_source,
  case when k % 23 = 0 then k end as exc_domain_id,
  k as domain_id,
  case when k % 7 = 0 then null else cast((k * 37) % 80 as int) end as google_search_results,
  case k % 6 when 0 then 'Offline' when 1 then 'Blocked' when 2 then 'Offline | Ad Sniffer' else 'Online' end as online_status,
  case when k % 9 = 0 then null else k % 8 = 0 end as redirect_domain,
  cast(case k % 10 when 1 then 1 when 2 then 2 when 3 then 3 when 4 then 9 end as int) as class_id,
  cast(case when k % 3 = 0 then 1 else 0 end as int) as publication_status,
  date '2025-01-01' + cast(k % 400 as int) as added,
  case when k % 3 = 0 then null else k % 5 in (1, 2) end as tld_poor,
  cast(case when k % 4 = 0 then null else k % 100 end as int) as site_map_count,
  case when k % 5 = 0 then null else k % 2 = 0 end as is_high_risk_geo,
  case when k % 11 = 0 then null else k % 3 = 0 end as ssl_poor,
  case when k % 7 = 6 then null else 'undeterminated' end as graymarket_label,
  cast(case k % 9 when 0 then 17 when 1 then 5 when 2 then 7 when 3 then null else 1 end as int) as media_type_id,
  cast(case when k % 6 = 0 then 0 when k % 6 = 1 then null else k % 50 end as int) as ad_count,
  cast(case when k % 13 = 0 then null else (k * 137) % 4000 end as int) as html_length,
  case when k % 12 = 2 then 'SimilarWeb' end as decision_source,
  case when k % 5 = 0 then null else date '2026-01-01' + cast(k % 200 as int) end as first_reported,
  case when k % 13 = 5 then null else k % 2 = 0 end as ad_density,
  cast(case when k % 4 = 1 then k % 9 end as int) as enforcement_id
from (select c_custkey as k, c_mktsegment from customer) c"""
_TREE = """select k as sec_domain_id, k % 2 = 0 as ssl_poor, case k % 5 when 0 then true when 1 then null else false end as high_traffic,
  k % 3 = 0 as is_ecommerce, case k % 4 when 0 then true when 1 then null else false end as mfa_engagement,
  k % 11 = 0 as has_affiliate_handoff,
  case k % 7 when 0 then 'mfa' when 1 then 'Adult Content' when 2 then 'Gambling & Betting' when 3 then 'Cryptocurrency Speculation' when 4 then 'Supplement / Nutra' when 5 then 'undeterminated' end as graymarket_label,
  k % 3 <> 1 as ad_density, k % 5 in (1, 2) as tld_poor, cast(case when k % 13 = 0 then null else (k * 137) % 4000 end as int) as html_length
from (select c_custkey as k from customer) c"""
_REFERRAL = f"""select o_custkey as d_sec_domain_id, h.sec_domain as destination_domain, l_suppkey as r_domain_id,
  cast(l_quantity as bigint) as referred_visits, cast(date_trunc('month', o_orderdate) as date) as month,
  cast(case when l_linenumber <= 4 then 2 else 1 end as int) as step_in_process,
  case when o_custkey % 29 = 0 then o_custkey end as d_exc_domain_id, case when o_custkey % 31 = 0 then o_custkey end as d_domain_id
from lineitem join orders on l_orderkey = o_orderkey join ({_HUB}) h on h.sec_domain_id = o_custkey"""

#: A paragraph of main text, and pages whose every field follows from the remainders of their number.
PARAGRAPH = "The river rose all night and by the morning the lower streets of the town stood under water, which the older people had seen only once before in their lives, while the council opened the school for the families who had to leave at short notice"
_FIELD_PAGES = f"""select html_id, a, b, c, d, e, g, '<html><head><title>' || case when c = 0 then 'Top 7 of it' else 'Calm' end || '</title><meta name="description" content=" D' || cast(html_id as string) || ' ">' || case when c = 1 then '<link rel="prefetch next" href="/2">' else '' end || '</head><body>'
 || repeat('<div class="ad banner"></div>', a) || repeat('<div class="x ad-slot"></div>', d) || repeat('<iframe src="/f"></iframe>', b) || repeat('<ins class="adsbygoogle"></ins>', c) || repeat('<amp-ad></amp-ad>', d)
 || case when e = 0 then '<div style="position: fixed"></div>' when e = 1 then '<video autoplay muted></video>' else '' end || case when g = 0 then '<div class="my popup"></div>' when g = 1 then '<a href="https://amzn.to/x">y</a>' else '' end
 || case when a = 0 then '<script>googletag.cmd</script>' else '' end || case when b = 0 then '<script src="//x.example/prebid.js"></script>' else '' end || repeat('<div class="taboola-x"></div>', e) || repeat('<a href="/page/2">more</a>', e) || repeat('<img src="https://cdn.shopify.com/a.png">', c)
 || repeat('<p>{PARAGRAPH}</p>', 1 + d) || '</body></html>' as html from (select page_id as html_id, cast(page_id % 5 as int) as a, cast(page_id % 4 as int) as b, cast(page_id % 3 as int) as c, cast(page_id % 2 as int) as d, cast(page_id % 6 as int) as e, cast(page_id % 7 as int) as g from pages) x"""

VIEWS: dict[str, str] = {
    "field_pages": _FIELD_PAGES,
    "hub": _HUB,
    "tree": _TREE,
    "referral_traffic": _REFERRAL,
    "referral_spellings": f"select d_sec_domain_id, destination_domain, r_domain_id, referred_visits, month, step_in_process, d_exc_domain_id, d_domain_id from ({_REFERRAL}) r union all select d_sec_domain_id, 'www.' || destination_domain, r_domain_id + 1, referred_visits, month, step_in_process, d_exc_domain_id, d_domain_id from ({_REFERRAL}) q where d_sec_domain_id % 3 = 0",
    "domain_attributes": "select s_suppkey as domain_id, 'd' || cast(s_suppkey as string) || '.com' as domain, cast(case s_suppkey % 5 when 0 then 1 when 1 then 16 when 2 then 7 end as int) as analyst_class, cast(s_suppkey % 6 as int) as ml_class from supplier",
    "tenants_domain": "select s_suppkey as domain_id, cast(s_nationkey as bigint) as tenant_id from supplier",
    "tenants": "select cast(n_nationkey as bigint) as tenant_id, n_regionkey <> 4 as customer_active from nation",
    "traffic_sources": "select c_custkey as sec_domain_id, cast(c_custkey % 61 as double) / 100 as direct_share, cast(c_custkey % 37 as double) / 100 as referrals_share, cast(c_custkey % 53 as double) / 100 as organic_share, cast(c_custkey % 17 as double) / 100 as display_share from customer where c_custkey % 41 <> 7",
    "ad_domains": "select 'building-' || cast(p_partkey as string) || case p_partkey % 5 when 0 then '.COM' when 1 then '.xyz' when 2 then '.top' when 3 then '.org' else '.net' end as ad_company_domain, case when p_partkey % 3 = 0 then 4375 else p_partkey end as ad_company_id from part",
    "dim_traffic": "select o_custkey as sec_domain_id, cast(date_trunc('month', o_orderdate) as date) as month, cast(floor(sum(o_totalprice) * 4) as bigint) as traffic, 'World' as domain_country from orders where o_orderkey % 2 = 0 group by 1, 2",
    "engagement": "select o_custkey as sec_domain_id, cast(date_trunc('month', o_orderdate) as date) as month, o_orderkey as fact_id, cast(o_orderkey % 100 as double) / 100 as bounce_rate, 1 + (o_orderkey % 7) * cast(0.5 as double) as pages_per_visit, case o_orderkey % 8 when 0 then null when 1 then '0' when 2 then cast(o_orderkey % 400 as string) when 3 then '00:0' || cast(o_orderkey % 6 as string) || ':30' when 4 then '0' || cast(o_orderkey % 5 as string) || ':45' when 5 then '01:75' when 6 then 'missing' else cast(o_orderkey % 300 as string) || '.5' end as avg_visit_duration from orders",
    "address_bar": f"select user_id as session_id, event_type as ad_event_id, cast(event_id % 3 as int) as tab_num, cast(row_number() over (partition by user_id, event_type, event_id % 3 order by event_id) - 1 as int) as bar_num, 'd' || cast(user_id % 7 as string) || '.com' as source_domain, case when event_id % 4 = 0 then 'd' || cast(event_id % 11 as string) || '.com' else lower(c_mktsegment) || '-' || cast(k as string) || '.' || {_TLD} end as bar_domain, case event_id % 5 when 0 then true when 1 then null else false end as landing_page from (select event_id, user_id, event_type, c_custkey as k, c_mktsegment from events join customer on c_custkey = 1 + event_id % 100) c",
    "ad_slots": "select o_orderkey as sec_domain_id, cast(case when o_orderkey % 9 = 0 then null else o_orderkey % 40 end as int) as ad_count, cast(case o_orderkey % 13 when 0 then null when 1 then 0 else 200 + o_orderkey % 3000 end as int) as html_length from orders",
    "certificates": "select p_partkey as cert_id, case when p_partkey % 19 = 0 then null when p_partkey % 3 = 0 then 'domain' else 'organization' end as validation_type, case when p_partkey % 19 = 0 then '' when p_partkey % 4 = 0 then 'Let''s Encrypt' when p_partkey % 4 = 1 then 'Google Trust Services' else 'DigiCert' end as issuer, timestamp '2024-01-01 00:00:00' as valid_from, case when p_partkey % 5 = 0 then timestamp '2024-03-31 00:00:01' when p_partkey % 5 = 1 then null else timestamp '2024-12-31 00:00:00' end as valid_to, case when p_partkey % 2 = 0 then 'RSA' else 'ECDSA' end as key_type, cast(case when p_partkey % 7 = 0 then 128 when p_partkey % 2 = 0 then 2048 else 256 end as int) as key_bits, case when p_partkey % 2 = 0 then '2.23.140.1.2.1' else '2.23.140.1.2.2' end as policies, case when p_partkey % 6 = 0 then '*.a.com' else 'a.com' end as dns_names from part",
    "ad_chain_urls": "select o_custkey as domain_id, 'u' || cast(l_partkey as string) as ad_url from lineitem join orders on l_orderkey = o_orderkey",
    "ad_url_features": "select 'u' || cast(p_partkey as string) as ad_url, p_partkey % 10 <> 0 as ad_rendering, case when p_partkey % 50 = 0 then null else true end as ad_creative from part",
    "snapshots": "select page_id as html_id, page_id % 40 as sec_domain_id, url, html as html_content from pages",
    "response_log": "select user_id as site, event_id as seq, event_type as url, cast(case event_id % 6 when 0 then 404 when 1 then 301 when 2 then 302 else 200 end as int) as status from events",
    "response_chain": "select site, seq, status, case seq % 4 when 0 then 'https://s' || cast(site as string) || '.com/p' when 1 then 'https://www.s' || cast(site as string) || '.com/p' when 2 then 'https://ads.example/x' else 'http://s' || cast(site as string) || '.com:80/q' end as url from (select user_id as site, event_id as seq, cast(case when user_id % 10 = 9 and event_id % 3 > 0 then 200 else case event_id % 6 when 0 then 404 when 1 then 301 when 2 then 302 when 3 then 307 else 200 end end as int) as status, row_number() over (partition by user_id order by event_id) as n from events) e where not (site % 6 = 0 and n > 1) and not (site % 6 = 1 and n > 3)",
    "site_pages": "select site, 's' || cast(site as string) || '.com' as domain, case site % 16 when 0 then 'https://alliance4creativity.com/x' when 1 then 'https://other.example/' when 2 then 'https://www.s' || cast(site as string) || '.com/' when 3 then 'https://www.s' || cast(site as string) || '.com/a' else 'https://s' || cast(site as string) || '.com/' end as page_url, case site % 9 when 0 then '<p>Domain Seized</p>' when 1 then '<p>This is no longer available due to copyright</p>' when 2 then '<p>Cloudflare Ray ID 5</p>' when 3 then '<p>404 Not Found</p>' when 4 then '<p>bad request</p>' when 5 then '<p>Buy this domain</p>' else '<p>Welcome home</p>' end as html from (select distinct user_id as site from events) e",
    "brands": "select case p_partkey % 5 when 0 then 'b-' || cast(p_partkey as string) when 1 then 'building-' || cast(p_partkey as string) when 2 then 'Household-' || cast(p_partkey as string) when 3 then null else 'machinery-' || cast(p_partkey as string) end as keyword, p_partkey % 3 > 0 as brand from part",
    "crawl_urls": f"select sec_domain_id as k, ssl_poor, mfa_engagement, high_traffic, case sec_domain_id % 11 when 0 then 'https://user:pw@www.' || sec_domain || ':8443/p?q#f' when 1 then 'http://10.' || cast(sec_domain_id % 300 as string) || '.0.1/x' when 2 then 'm.a' || cast(sec_domain_id % 50 as string) || '.pages.dev' when 3 then 'w.x' || cast(sec_domain_id % 70 as string) || '.co.uk/a@b' when 4 then ' HTTPS://SHOP.b' || cast(sec_domain_id as string) || '.Example.COM. ' when 5 then 'http://[2001:db8::' || cast(sec_domain_id % 90 as string) || ']:80/' when 6 then 'www.s' || cast(sec_domain_id % 40 as string) || '.city.kawasaki.jp' when 7 then 'a.s' || cast(sec_domain_id % 40 as string) || '.b.kawasaki.jp' when 8 then 'co.uk' when 9 then case when sec_domain_id % 2 = 0 then '' end else 'db.host' || cast(sec_domain_id % 30 as string) || '.intranet' end as url from (select h.sec_domain_id, h.sec_domain, t.ssl_poor, t.mfa_engagement, t.high_traffic from ({_HUB}) h join ({_TREE}) t on t.sec_domain_id = h.sec_domain_id) z",
    "structured_pages": """select page_id as html_id, html || case page_id % 8 when 0 then '<script type="application/ld+json">{"@type": "Movie", "name": "m' || cast(page_id as string) || '", "description": "d", "image": null, "datePublished": "x", "director": {"@type": "Person"}, "actor": [], "genre": "g"' || case when page_id % 3 = 0 then ', "provider": 1' else '' end || '}</script>'
   when 1 then '<script type="application/ld+json"> [{"@type": "Product", "name": "n", "sku": 5}, {"@type": ["Book", "Thing"], "name": "b", "author": "a", "datePublished": 1, "isbn": "i", "publisher": "p", "description": "x"}] </script>'
   when 2 then '<script type=''application/ld+json''>{"@type": ["VideoGame", "Product"], "name": "n", "description": "d", "image": "i", "gamePlatform": "g", "datePublished": "x", "publisher": "p"}</script>'
   when 3 then '<script type="application/ld+json">{"@type": "Movie", </script><script type="application/ld+json">{"@type": "MusicGroup", "n' || cast(page_id % 4 as string) || '": 1}</script>'
   when 4 then '<script type="text/javascript">{"@type": "Movie"}</script>'
   when 5 then '<script type="application/ld+json">[1, "Movie", null, {"name": "x"}, {"@type": null}, {"@type": ["Movie", "Movie"], "@id": 1}, {"@type": "T' || cast(page_id % 5 as string) || '"}]</script>'
   when 6 then '<script type="application/ld+json"></script>' else '' end as html from pages""",
    "wide_snapshots": "select page_id as html_id, 1 + (page_id * 19) % 1500 as sec_domain_id, url, html as html_content from pages",
    "captures": """select page_id as capture_id, 'From: x' || chr(13) || chr(10) || case page_id % 5 when 0 then 'Content-Type: text/plain' when 1 then 'Content-Type: text/html; charset=utf-8' else 'Content-Type: text/html' end || chr(13) || chr(10) || 'Q: y' || chr(13) || chr(10) || chr(13) || chr(10) || case page_id % 3 when 0 then '<!DOCTYPE html>' when 1 then '<HTML lang="x">' else 'bare ' end || url || case page_id % 4 when 0 then '<img src="data:image/png;base64,' || repeat('Ab+/', 90) || '">' else '' end
   || case page_id % 7 when 0 then '' when 1 then chr(10) || '--abcdefghij12' || chr(10) || 'z' when 2 then chr(10) || 'Content-Type: image/png' || chr(10) else chr(13) || chr(10) || '------MultipartBoundary--z' || chr(13) || chr(10) || 'Content-Type: image/png' end as mhtml,
  case page_id % 6 when 0 then '{"cpm": ' || cast(page_id % 17 as string) || ', "publisher": "p' || cast(page_id as string) || '", "buyer": "' || case when page_id % 4 = 0 then '' else 'b' || cast(page_id % 13 as string) end || '"}' when 1 then '{"cpm": 1,' when 2 then '<?XML version="1.0"?><VAST id="' || cast(page_id as string) || '"/>' when 3 then '{"price": 2, "publisher": "q"}' when 4 then null else '[{"publisher" : "r", "cpm":3}]' end as body,
  case page_id % 4 when 0 then 'about:blank' when 1 then url || ' chrome-error://chromewebdata/' when 2 then url || ' about:blank ' || url else '' end as popups,
  case page_id % 9 when 0 then 'Pulsa en Permitir' when 1 then 'hello and Welcome to nginx! on this host' when 2 then 'we saw Error code 520 here today' when 3 then 'three words only' when 4 then 'Connection timed out' else 'four words or more ' || url end as text from pages""",
    "serp_payloads": f"""select sec_domain as domain, k, case k % 11 when 0 then '{{"results": [' when 1 then null when 2 then '{{"results": []}}' when 3 then '{{"results": [{{"content": null}}, {{"content": {{"results": {{"organic": [{{"title": "no url"}}]}}}}}}]}}'
   else '{{"results": [{{"content": {{"results": {{"organic": [{{"url": "https://a.' || sec_domain || '/x"}}, {{"url": "http://' || case when k % 2 = 0 then 'www.' else '' end || sec_domain || '"}}, {{"url": "https://other' || cast(k % 5 as string) || '.example/?q=' || sec_domain || '"}}]}}}}}}, {{"content": {{"results": {{"organic": ['
    || case when k % 3 = 0 then '{{"url": "https://a.' || sec_domain || '/y"}}' else '' end || ']}}}}}}]}}' end as payload,
  case k % 4 when 0 then 'running' else 'ready' end as job, case k % 9 when 0 then '{{' when 1 then '[{{"organic": []}}]' when 2 then '[]' else '[{{"organic": [' || case when k % 2 = 0 then '{{"url": "u"}}, ' else '' end || '{{"url": "v' || cast(k as string) || '"}}, {{}}]}}, {{"organic": [{{"url": "w"}}]}}]' end as answer from (select sec_domain_id as k, sec_domain from ({_HUB}) h) x""",
    "audits": """select page_id as html_id, case page_id % 8 when 0 then null when 1 then '{"lighthouseResult": {"categories": {}}}' when 2 then 'oops' else '{"lighthouseResult": {"categories": {"performance": {"score": 0.' || cast(10 + page_id % 90 as string) || '}}, "audits": {"lcp": {"numericValue": ' || cast(page_id * 3 as string) || '.5}, "cls": {"numericValue": ' || case when page_id % 3 = 0 then 'null' else '0.' || cast(page_id % 7 as string) end || '}}}}' end as audit,
  case page_id % 5 when 0 then null when 1 then '<urlset></urlset>' else '<urlset>' || repeat('<url><loc>' || url || '</loc><lastmod>x</lastmod></url>' || chr(10), cast(page_id % 13 as int)) || '</urlset>' end as sitemap,
  case page_id % 6 when 0 then 'https://www.a' || cast(page_id % 9 as string) || '.b.com:8080/x?y' when 1 then 'http://user@ads.example/p' when 2 then 'c.d.e.f/z' when 3 then url when 4 then 'x.y.z' || chr(10) || 'w' else '' end as bid_url,
  case page_id % 7 when 0 then '**Adult Content**' when 1 then 'Gambling & Betting' || chr(10) || 'because of ' || url when 2 then ' "Supplement / Nutra". ' when 3 then 'adult content' when 4 then null when 5 then '' else 'Label ' || cast(page_id % 3 as string) end as answer,
  case page_id % 4 when 0 then 'Redirect' when 1 then 'redirect' when 2 then null else 'Redirect - same domain' end as offline_type from pages""",
    "certificate_payloads": """select 'c' || cast(k as string) as domain, case k % 9 when 0 then null when 1 then '{"ip": ' when 2 then '{"ip":"1.1.1.1","port":443,"certificates":[]}' else '{"ip":"10.0.' || cast(k % 256 as string) || '.1","port":' || cast(400 + k % 50 as string) || ',"auditCreated":"2025-0' || cast(1 + k % 9 as string) || '-02T03:04:05' || case when k % 2 = 0 then 'Z' else '' end || '","certificates":[{"chainHierarchy":"leaf","validationType":"' || case k % 3 when 0 then 'domain' when 1 then 'organization' else '' end
   || '","validFrom":"2024-01-0' || cast(1 + k % 7 as string) || 'T00:00:00Z","validTo":' || case when k % 5 = 0 then 'null' when k % 5 = 1 then '"soon"' else '"2024-12-31T23:59:59"' end || ',"serialNumber":"' || cast(k * 17 as string) || '","signatureAlgorithm":"SHA256","subject":{"commonName":"c' || cast(k as string) || '.com"},"issuer":{"organization":"O' || cast(k % 7 as string) || '"},"publicKey":{"type":"RSA","bits":' || cast(1024 * (1 + k % 3) as string) || '}'
   || case when k % 3 = 0 then '' else ',"extensions":{"authorityKeyIdentifier":"a' || cast(k % 4 as string) || '","keyUsage":["sign","enc"],"crlDistributionPoints":[],"subjectAlternativeNames":{"dnsNames":["*.a.com","b' || cast(k as string) || '.com"]},"authorityInfoAccess":{"issuers":["http://i"]}}' end || '}' || case when k % 4 = 0 then ',{"chainHierarchy":"root","issuer":{"country":"US","commonName":"CA"},"extensions":{}}' else '' end || ']}' end as payload from (select p_partkey as k from part) x""",
    "suffixes": "select * from (values ('com'), ('net'), ('org'), ('xyz'), ('top'), ('dev'), ('uk'), ('co.uk'), ('jp'), ('*.kawasaki.jp'), ('!city.kawasaki.jp')) v(suffix)",
    "tld_list": "select * from (values ('co'), ('com'), ('Example'), ('kawasaki ')) v(tld)",
    "asn_lookup": "select s_suppkey as domain_id, case s_suppkey % 12 when 0 then 'RU' when 1 then 'CN' when 2 then 'US' when 3 then 'PA' when 4 then null when 5 then 'UK' when 6 then 'Viet Nam' when 7 then 'Iran, Islamic Republic of' when 8 then 'Venezuela, Bolivarian Republic of' when 9 then 'us' else 'DE' end as country, s_suppkey % 7 <> 0 as ok, case s_suppkey % 5 when 0 then null when 1 then '197414' else cast(s_suppkey as string) end as asn, case s_suppkey % 4 when 0 then 'unknown' when 1 then null else '2011-0' || cast(1 + s_suppkey % 9 as string) || '-10' end as asn_date, '10.0.' || cast(s_suppkey % 7 as string) || '.' || cast(s_suppkey % 200 as string) as ip from supplier",
}

#: Sums of doubles by view, and the same without error for values of up to six decimals.
EXACT = {"dim_traffic": ("sum(o_totalprice)", "sum(cast(o_totalprice as decimal(24, 6)))")}


def sql_with(names: list[str], body: str) -> str:
    """body with the views it reads in a WITH clause, for DuckDB."""
    return "with " + ", ".join(f"{n} as ({VIEWS[n]})" for n in names) + " " + body


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view as a lazy DataFrame; only the tables that it names are touched."""
    text, used = VIEWS[name].replace(*EXACT.get(name, ("", ""))).replace("{", "{{").replace("}", "}}"), {}  # spark.sql formats the text
    for t in TABLES:
        for kw in ("from", "join"):
            if f"{kw} {t} " in text + " " or f"{kw} {t})" in text:
                used[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet")
                text = (text + " ").replace(f"{kw} {t} ", f"{kw} {{{t}}} ").replace(f"{kw} {t})", f"{kw} {{{t}}})")
    return spark.sql(text, **used) if used else spark.sql(VIEWS[name])

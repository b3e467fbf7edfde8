"""Queries over landed payloads that vary, whose SQL reads the same texts with functions of its own; importing the module registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import captures, scorers
from riskloom.plans.queries import query
from riskloom.sources import files
from riskloom.sources.adapters import load


@query("serp_hosts_landed", ["serp_payloads"], """select domain, count(*) filter (hit) as n_urls, count(distinct host) filter (hit) as n_hosts from (select domain, host, contains(host, lower(domain)) as hit from
 (select domain, regexp_extract(u, 'https?://([^/]+)', 1) as host from (select domain, unnest(case when json_valid(payload) and len(json_extract_string(payload, '$.results[*].content.results.organic[*].url')) > 0 then json_extract_string(payload, '$.results[*].content.results.organic[*].url') else [null] end) as u from serp_payloads) a) b) c group by domain""")
def _(s, d):
    """Result URLs whose host holds the domain, from answers of several pages, with null and empty parts, and broken ones."""
    return files.serp_hosts(load(s, d, "serp_payloads"))


@query("serp_counts_landed", ["serp_payloads"], """select domain, case when json_valid(payload) then cast(case when json_type(json_extract(payload, '$.results[0].content.results.organic')) = 'ARRAY' then json_array_length(json_extract(payload, '$.results[0].content.results.organic')) end as int) end as first_page,
 case when job = 'ready' and json_valid(answer) then cast(case when json_type(json_extract(answer, '$[0].organic')) = 'ARRAY' then json_array_length(json_extract(answer, '$[0].organic')) end as int) end as job_results from serp_payloads""")
def _(s, d):
    """Results of the first page, of searches that waited for their answer and of those that asked for it later."""
    x = load(s, d, "serp_payloads")
    return x.select("domain", files.serp_first_page(F.col("payload")).alias("first_page"), files.serp_job(F.col("job"), F.col("answer")).alias("job_results"))


_NUMBER = lambda path: f"coalesce(case when json_valid(audit) then try_cast(json_extract_string(audit, '$.lighthouseResult.{path}') as double) end, 0)"


@query("audits_landed", ["audits"], f"""select html_id, round({_NUMBER('categories.performance.score')} * 100, 6) as score, {_NUMBER('audits.lcp.numericValue')} as lcp, {_NUMBER('audits.cls.numericValue')} as cls, cast(len(regexp_extract_all(coalesce(sitemap, ''), '<loc>(.*?)</loc>')) as int) as n_locs,
 full_domain, case when len(p) = 3 then p[2] || '.' || p[3] end as domain, case when len(p) = 3 then p[1] end as subdomain, case when label in ('Adult Content', 'Gambling & Betting', 'Cryptocurrency Speculation', 'Supplement / Nutra', 'undeterminated') then label else 'undeterminated' end as label, coalesce(offline_type = 'Redirect', false) as redirect_domain
 from (select *, string_split(full_domain, '.') as p, trim(regexp_replace(string_split(answer, chr(10))[1], '[^A-Za-z0-9_ &/]', '', 'g')) as label from (select *, regexp_extract(bid_url, '^(?:https?://)?(?:[^@\\n]+@)?(?:www\\.)?([^:/\\n?]+)', 1) as full_domain from audits) a) b""")
def _(s, d):
    """Page speed, sitemaps, bid hosts, a scorer's label and the outcome of a crawl, from texts as they landed."""
    speed, host = captures.page_speed(F.col("audit")), captures.bid_host(F.col("bid_url"))
    return load(s, d, "audits").select(
        "html_id", F.round(speed["score"], 6).alias("score"), speed["lcp"].alias("lcp"), speed["cls"].alias("cls"), captures.sitemap_count(F.col("sitemap")).alias("n_locs"), *[c.alias(k) for k, c in host.items()],
        captures.clean_label(F.col("answer"), scorers.GRAYMARKET, "undeterminated").alias("label"), captures.crawl_outcome(F.col("offline_type")).alias("redirect_domain"),
    )


_TEXT_OF = {
    "chain_hierarchy": "chainHierarchy", "validation_type": "validationType", "serial_number": "serialNumber", "signature_algorithm": "signatureAlgorithm", "subject_common_name": "subject.commonName",
    "issuer_country": "issuer.country", "issuer_organization": "issuer.organization", "issuer_common_name": "issuer.commonName", "authority_key_identifier": "extensions.authorityKeyIdentifier", "subject_key_identifier": "extensions.subjectKeyIdentifier", "public_key_type": "publicKey.type",
}
_LIST_OF = {
    "key_usage": "keyUsage", "extended_key_usage": "extendedKeyUsage", "crl_distribution_points": "crlDistributionPoints", "aia_issuers": "authorityInfoAccess.issuers", "aia_ocsp": "authorityInfoAccess.ocsp",
    "dns_names": "subjectAlternativeNames.dnsNames", "certificate_policies": "certificatePolicies",
}
_TIME = lambda x: f"try_cast(regexp_replace({x}, 'Z$', '') as timestamp)"


@query("certificates_landed", ["certificate_payloads"], f"""select domain as requested_domain, case when c is not null then json_extract_string(payload, '$.ip') end as ip, case when c is not null then cast(json_extract_string(payload, '$.port') as int) end as port, case when c is not null then {_TIME("json_extract_string(payload, '$.auditCreated')")} end as audit_created,
 {', '.join(f"json_extract_string(c, '$.{path}') as {name}" for name, path in _TEXT_OF.items())}, {', '.join(f"case when json_type(c, '$.extensions') = 'OBJECT' then coalesce(cast(json_extract(c, '$.extensions.{path}') as varchar), '') end as {name}" for name, path in _LIST_OF.items())},
 {_TIME("json_extract_string(c, '$.validFrom')")} as valid_from, {_TIME("json_extract_string(c, '$.validTo')")} as valid_to, cast(json_extract_string(c, '$.publicKey.bits') as int) as public_key_bits
 from (select domain, payload, unnest(case when json_valid(payload) and json_array_length(payload, '$.certificates') > 0 then cast(json_extract(payload, '$.certificates[*]') as json[]) else [null] end) as c from certificate_payloads) x""")
def _(s, d):
    """A row for each certificate of landed payloads, with and without extensions; one of nulls for answers that are empty, broken or missing."""
    return files.certificates(load(s, d, "certificate_payloads"))

"""Links: hosts, kinds, verdicts of fetched pages, freshness, normal forms, suggestions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessitura.functions.strings import count_words, fold

# Second-level domains, hosts of kinds, hosts of parked pages.
SECOND_LEVEL = ("co", "com", "org", "net", "ac", "gov")
KINDS = {"instagram.com": "instagram", "facebook.com": "facebook", "x.com": "twitter", "twitter.com": "twitter", "youtube.com": "youtube", "youtu.be": "youtube", "linkedin.com": "linkedin", "vimeo.com": "vimeo"}
PARKED_HOSTS = (
    "sedoparking.com", "sedo.com", "hugedomains.com", "dan.com", "afternic.com", "parkingcrew.net", "bodis.com", "above.com", "domainmarket.com", "buydomains.com",
    "parklogic.com", "undeveloped.com", "squadhelp.com", "brandbucket.com", "uniregistry.com", "sav.com", "domainsponsor.com", "hostgator.com/domain", "dynadot.com/market",
)
# What a parked page says, what the title of a missing page begins with, what that of a placeholder does,
# hosts that only shorten addresses, and services that were renamed.
PARKED_SAYS = (
    "this domain (?:name )?(?:is|may be) (?:for sale|available)", "domain (?:name )?is for sale", "buy this domain", "the domain .{0,80} is for sale", "is parked",
    "parked (?:free )?(?:at|by|domain|with)", "domain parking", "this (?:web ?)?page is parked", "this domain has expired", "domain (?:has )?expired",
    "inquire (?:about|on) this domain", "make an offer (?:on|for) this domain", "for sale by owner", "related searches", "sponsored listings",
)
MISSING_TITLES = (
    r"(?:error\s*)?(?:404|page not found|not found|site not found|domain not found|this site can.t be reached|account (?:has been )?suspended|website (?:is )?(?:suspended|disabled))\b",
)
PLACEHOLDER_TITLES = (
    "coming soon", "under construction", "default web ?site page", "welcome to nginx", "apache2? (?:ubuntu )?default page", "index of /", "site (?:is )?not (?:yet )?published", "website expired",
)
SHORTENERS = ("bit.ly", "tinyurl.com", "goo.gl", "ow.ly", "t.co", "y.at", "linktr.ee", "lnk.bio")
RENAMED = {"discordapp.com": "discord.com", "warpcast.com": "farcaster.xyz", "twitter.com": "x.com"}
#: A page of fewer characters that sends on, of fewer words that offers a domain, of fewer words that holds a place.
SHORT_PAGE, SHORT_OFFER, SHORT_PLACEHOLDER = 1500, 900, 80


def host(url: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), r"^www\.", ""))


def registrable(h: Column) -> Column:
    """The last two labels of a host, three under a second-level domain such as co.uk."""
    p = F.split(h, r"\.")
    n = F.when((F.size(p) >= 3) & (F.length(F.element_at(p, -1)) == 2) & F.element_at(p, -2).isin(*SECOND_LEVEL), 3).otherwise(2)
    return F.when(F.size(p) <= 2, h).otherwise(F.array_join(F.slice(p, -n, n), "."))


def kind_of(url: Column, alt: Column | None = None) -> Column:
    """The kind of a link by its icon's text, else by its host."""
    by_host = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv]), registrable(host(url))), F.lit("website"))
    if alt is None:
        return by_host
    by_alt = F.coalesce(*[F.when(F.lower(alt).contains(k), F.lit(k)) for k in sorted(set(KINDS.values()))])
    return F.coalesce(by_alt, by_host)


def page_text(body: Column) -> Column:
    """A page's text: without scripts, styles and tags."""
    for tag in ("script", "style"):
        body = F.regexp_replace(body, rf"(?is)<{tag}[^>]*>.*?</{tag}>", " ")
    return F.regexp_replace(body, "<[^>]+>", " ")


def page_title(body: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(body, "(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))


def page_verdict(body: Column, final: Column, url: Column) -> Column:
    """What a page is that was fetched for url and came from final: parked (for sale, parked or a placeholder), broken (it only
    says not found), changed (another site, or a site's front page for a page of it), or ok; the first that holds."""
    site = host(final)
    path = lambda u: F.trim(F.regexp_extract(u, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit("/"))
    full = F.lower(F.concat(site, F.regexp_extract(final, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)))
    title, text = page_title(body), page_text(body)
    n, short = count_words(text), F.length(body) < SHORT_PAGE
    any_of = lambda parts: "(?:" + "|".join(parts) + ")"
    parked = full.rlike(any_of(h.replace(".", "[.]") for h in PARKED_HOSTS))
    parked = parked | short & (body.rlike("(?i)location[.]href\\s*=\\s*[\"']/lander") | body.contains("cgi-sys/defaultwebpage"))
    gone = F.lower(path(final)).rlike("(?:^|/)(?:missing|not-?found|404)$") | title.rlike(r"(?i)^\W*" + any_of(MISSING_TITLES))
    offered = text.rlike("(?i)" + any_of(PARKED_SAYS)) & (n < SHORT_OFFER) | title.rlike(r"(?i)^\W*" + any_of(PLACEHOLDER_TITLES)) & (n < SHORT_PLACEHOLDER)
    old, new = registrable(host(url)), registrable(site)
    shortened = host(url).rlike(any_of(h.replace(".", "[.]") for h in SHORTENERS) + "$")
    renamed = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in RENAMED.items() for x in kv]), old) == new, F.lit(False))
    front = (path(url) != "") & (path(final) == "") & (F.regexp_extract(final, r"[?]([^#]*)", 1) == "")
    changed = ~shortened & ((old != new) & ~renamed | (old == new) & front)
    verdict = F.when(parked, "parked").when(gone, "broken").when(offered, "parked").when(changed, "changed")
    return F.coalesce(verdict, F.lit("ok"))


def http_status(code: Column) -> Column:
    """ok under 400; broken for 404, 410 and names that don't resolve (0); unverified for the rest, which may be a guard."""
    return F.when(code.between(200, 399), "ok").when(code.isin(0, 404, 410), "broken").otherwise("unverified")


def due_for_check(links: DataFrame, status: DataFrame, key: str, today: str, days: int = 30, version: int = 1, only_broken: bool = False) -> DataFrame:
    """links never checked, checked under an older rule or too long ago; or just those last found broken. today is a parameter."""
    s = status.select(F.col(key).alias("_k"), "status", "checked", "v")
    j = links.join(s, F.col(key) == F.col("_k"), "left")
    due = F.col("_k").isNull() | (F.col("v") < version) | (F.datediff(F.lit(today).cast("date"), "checked") > days)
    return j.where(F.coalesce(F.col("status") == "broken", F.lit(False)) if only_broken else due).select(*links.columns)


def normal_url(url: Column) -> Column:
    """Scheme and host in lower case, https for http, no fragment, no slash at the end."""
    site = F.lower(F.regexp_extract(url, r"^([a-zA-Z]+://[^/?#]*)", 1))
    rest = F.substr(url, F.length(site) + 1)
    return F.concat(F.regexp_replace(site, "^http://", "https://"), F.regexp_replace(F.regexp_replace(rest, "#.*$", ""), "/+$", ""))


def best_links(links: DataFrame, key: str) -> DataFrame:
    """links(key, kind, url, idx, works, override) to one for each kind: overrides first, then those that work, then the earliest."""
    u = links.withColumn("url", normal_url(F.col("url")))
    rank = F.struct((~F.col("override")).alias("o"), (~F.col("works")).alias("w"), F.col("idx"), F.col("url"))
    return u.groupBy(key, "kind").agg(F.min_by("url", rank).alias("url"), F.count_distinct("url").alias("known"))


def candidate_sites(name: Column) -> Column:
    """Addresses that a person of this name might have; they are only made, not asked."""
    t = F.filter(F.split(F.regexp_replace(F.lower(fold(name)), "[^a-z ]", ""), " +"), lambda x: x != "")
    joined, dashed, back = F.array_join(t, ""), F.array_join(t, "-"), F.array_join(F.reverse(t), "")
    hosts = F.array(*[F.concat(j, F.lit(e)) for j in (joined, dashed, back) for e in (".com", ".net", ".art")], F.concat(joined, F.lit("art.com")), F.concat(joined, F.lit("studio.com")))
    return F.array_distinct(hosts)


def redirect_target(detail: Column) -> Column:
    return F.nullif(F.regexp_extract(detail, r"(?i)redirects? to (\S+?)[.,;)]*(?:\s|$)", 1), F.lit(""))


def refresh_cache(cache: DataFrame, fetched: DataFrame, unwanted: DataFrame, key: str) -> DataFrame:
    """cache(key, rev, body) with changed revisions replaced, new ones added and unwanted ones removed: (key, rev, body, action)."""
    f = fetched.select(F.col(key).alias("_k"), F.col("rev").alias("_r"), F.col("body").alias("_b"))
    j = cache.join(f, F.col(key) == F.col("_k"), "full")
    action = F.when(F.col(key).isNull(), "added").when(F.col("_k").isNull() | (F.col("_r") == F.col("rev")), "kept").otherwise("updated")
    new = action != "kept"
    merged = j.select(F.coalesce(key, "_k").alias(key), F.when(new, F.col("_r")).otherwise(F.col("rev")).alias("rev"), F.when(new, F.col("_b")).otherwise(F.col("body")).alias("body"), action.alias("action"))
    return merged.join(unwanted.select(key).distinct(), key, "left_anti")


def link_report(links: DataFrame, status: DataFrame, key: str, kinds: Sequence[str]) -> DataFrame:
    """(key, a column a kind with its statuses, none_works): a row for each person."""
    j = links.join(status, "url", "left").withColumn("status", F.coalesce("status", F.lit("unverified")))
    shown = F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "status", "url"))), "; ")
    wide = j.groupBy(key).pivot("kind", list(kinds)).agg(shown)
    any_ = j.groupBy(key).agg((~F.bool_or(F.col("status") == "ok")).alias("none_works"))
    return wide.join(any_, key).na.fill("", list(kinds))


def match_directory(lines: DataFrame, pages: DataFrame, line_key: Column, page_key: Column) -> DataFrame:
    """lines with a status: matched, no page (a known person without one) or unmatched. pages(name, page)."""
    p = pages.groupBy(page_key.alias("_k")).agg(F.max("page").alias("_page"))
    j = lines.withColumn("_l", line_key).join(p, F.col("_l") == F.col("_k"), "left")
    return j.select(*lines.columns, F.when(F.col("_k").isNull(), "unmatched").when(F.col("_page").isNull(), "no page").otherwise("matched").alias("status"))

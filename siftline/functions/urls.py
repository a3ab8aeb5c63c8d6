"""URL and domain column functions. The normalizers differ on purpose; each serves its own lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import any_of, strip
from .values import EXEMPT_WITH, EXEMPT_WITHOUT, GAMBLING_ADULT_PATTERNS, PLATFORM_ROOTS, SUSPICIOUS_TOKENS

SCHEME = "[a-z][a-z0-9+.-]*:"


def host(v: Column) -> Column:
    """What stands between // and the next / ? or #, with user, port and case as they are. Without :// anywhere, that is
    what stands before the first of them; a scheme without // goes.

    Here and below, an expression takes its input once, so that nested ones don't grow by a factor with each step.
    """
    return F.regexp_extract(v, f"(?s)^(?:(?=.*://){SCHEME}(?://)?)?([^/?#]*)", 1)


def bare_domain(c: Column) -> Column:
    """The lower-cased host without user, port, outer dots and one www.; empty for null. Nothing is validated."""
    h = host(F.lower(strip(F.coalesce(c, F.lit("")))))
    h = F.substring_index(F.substring_index(h, "@", -1), ":", 1)
    return F.regexp_replace(F.btrim(h, F.lit(".")), "^www\\.", "")


def normalize_domain(c: Column) -> Column:
    """bare_domain where it has a dot and only a-z, 0-9, dots and dashes, else empty."""
    return F.regexp_extract(bare_domain(c), "^([a-z0-9-]*[.][a-z0-9.-]*)$", 1)


def normalize_url(c: Column) -> Column:
    """Stripped, with http:// in front if there is no scheme; empty stays empty."""
    return F.regexp_replace(strip(F.coalesce(c, F.lit(""))), "(?s)^(?=.)(?!.*://)", "http://")


def canonical_url(c: Column) -> Column:
    """As normalize_url, but empty becomes http:// too."""
    return F.regexp_replace(strip(c), "(?s)^(?!.*://)", "http://")


def domain_only(c: Column) -> Column:
    """Without http(s):// and www., up to the first slash; a port stays."""
    v = F.regexp_replace(F.regexp_replace(F.lower(strip(c)), "^https?://", ""), "^www\\.", "")
    return strip(F.substring_index(v, "/", 1))


def fetch_key(c: Column) -> Column:
    """Without http(s)://, up to the first slash; www. and a port stay."""
    return F.substring_index(F.regexp_replace(F.lower(strip(c)), "^https?://", ""), "/", 1)


def listed_domain(c: Column) -> Column:
    """The domain of a line of a domain list, before the rules that drop it; null for markup and empty lines."""
    v = F.lower(strip(c))
    markup = v.rlike("^$|[<>]|xmlns=|fill=")
    d = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "^https?://", ""), "^\\*\\.", ""), "^\\.", "")
    return F.when(~markup, strip(F.substring_index(F.substring_index(d, "/", 1), ":", 1)))


def is_platform_root(d: Column) -> Column:
    return d.isin(PLATFORM_ROOTS)


def is_gambling_or_adult(d: Column) -> Column:
    has = lambda word: F.contains(d, F.lit(word))
    exempt = F.lit(True)
    for w in EXEMPT_WITH:
        exempt = exempt & has(w)
    for w in EXEMPT_WITHOUT:
        exempt = exempt & ~has(w)
    return d.rlike(any_of(GAMBLING_ADULT_PATTERNS, "")) & ~exempt


def allowed_domain(d: Column, blacklist: bool = True) -> Column:
    """Whether a listed domain stays: not without a dot or with other characters; in blacklists no platform roots,
    gambling and adult sites either. One expression that takes d once, as a filter may be told in terms of what d is."""
    valid = "(?=[^.]*[.])[a-z0-9.-]+$"
    if not blacklist:
        return d.rlike("^" + valid)
    roots = "|".join(r.replace(".", "[.]") for r in PLATFORM_ROOTS)
    exempt = "".join(f"(?=.*{w})" for w in EXEMPT_WITH) + "".join(f"(?!.*{w})" for w in EXEMPT_WITHOUT)
    return d.rlike(f"^(?!(?:{roots})$)(?:{exempt}|(?!.*(?:{any_of(GAMBLING_ADULT_PATTERNS, '')}))){valid}")


def clean_domain(c: Column, blacklist: bool = True) -> Column:
    """The domain that a line stands for, or null where it doesn't stay."""
    d = listed_domain(c)
    return F.when(allowed_domain(d, blacklist), d)


def subdomain_count(d: Column) -> Column:
    return F.greatest(F.size(F.split(d, "[.]")) - 2, F.lit(0))


def tld(d: Column) -> Column:
    return F.when(F.contains(d, F.lit(".")), F.element_at(F.split(d, "[.]"), -1)).otherwise("")


def suspicious_tokens(domain: Column, url: Column, tokens: list[str] = SUSPICIOUS_TOKENS) -> Column:
    text = F.lower(F.concat(domain, F.lit(" "), url))
    return F.filter(F.array(*(F.lit(t) for t in sorted(tokens))), lambda t: F.contains(text, t))


def record_id(label: Column, domain: Column) -> Column:
    kind = F.when(label == 1, "phish").when(label == 0, "legit").otherwise("unknown")
    return F.concat(kind, F.lit("_"), F.substring(F.sha1(F.concat_ws(":", label.cast("string"), domain)), 1, 12))


def netloc(href: Column) -> Column:
    return F.regexp_extract(href, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def absolute_links(hrefs: Column) -> Column:
    """Those that begin with http:// or https:// as written; fragments, scripts, mail and telephone links go with the rest."""
    return F.filter(hrefs, lambda h: h.rlike("^https?://"))


def link_domains(links: Column, page_url: Column) -> Column:
    """Sorted distinct hosts, lower-cased, that differ from the page's as written; www. is dropped after comparing."""
    own = page_host(page_url)
    hosts = F.filter(F.transform(links, lambda h: F.lower(netloc(h))), lambda d: (d != "") & (d != own))
    return F.array_sort(F.array_distinct(F.transform(hosts, lambda d: F.regexp_replace(d, "^www\\.", ""))))


def page_host(url: Column) -> Column:
    return netloc(F.regexp_replace(url, "(?s)^(?!.*://)", "http://"))

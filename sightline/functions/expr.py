"""Column expressions (JVM-side built-ins only, no Python UDFs).

Every function takes and returns ``Column`` objects so it can be used inside any
job and stays inside whole-stage code generation.
"""

from __future__ import annotations

import base64
import hashlib
import re
import string

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Spread buckets of the convergence report: upper bound in seconds, label, order.
SPREAD_BUCKETS = [(60, "< 1 min", 1), (300, "1-5 min", 2), (900, "5-15 min", 3),
                  (3600, "15-60 min", 4)]
SPREAD_LAST = ("> 1 hour", 5)
SLUG_MAX_LEN = 80          # slug text is cut at 80 characters before the hash
SLUG_HASH_LEN = 8          # first 8 hex digits of sha256(query)
SUBSET_PCT = 95.0          # "a is ~subset of b" threshold, percent
PREVIEW_QUERY = 50         # query preview length in the convergence sample
PREVIEW_USER = 12          # user preview length in the convergence sample
SALT_KEY_LEN = 32          # a key of this length is used as the salt as it is
# Default thresholds (parameters everywhere they are used).
MIN_TOP_USERS = 5
MIN_DETAIL_USERS = 35
MAX_QUERY_WORDS = 100
RECENT_DAYS = 90
SIMILAR_TOP_N = 20
SIMILAR_MIN_SHARED = 5


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value) -> Column:
    """Timestamp literal read in the session time zone (UTC), independent of
    the driver machine's local zone."""
    if hasattr(value, "isoformat"):
        value = value.isoformat(sep=" ") if hasattr(value, "hour") else value.isoformat()
    return F.lit(str(value)).cast("timestamp")


def normalize_query(q) -> Column:
    """``lower(trim(q))``; trim strips spaces only (tabs stay)."""
    return F.lower(F.trim(col(q)))


def event_date(ts) -> Column:
    return F.to_date(col(ts))


def month_key(d) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def iso_week_key(d) -> Column:
    """``{iso_year}-W{iso_week:02d}``; weeks start on Monday (ISO 8601)."""
    d = col(d)
    return F.concat(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("-W"),
                    F.lpad(F.weekofyear(d).cast("string"), 2, "0"))


def week_start(d) -> Column:
    """Monday on or before ``d`` (pure date arithmetic, no time zone)."""
    return F.date_sub(F.next_day(col(d), "Mon"), 7)


def week_end(d) -> Column:
    return F.date_add(week_start(d), 6)


def month_start(d) -> Column:
    return F.trunc(col(d), "month")


def month_end(d) -> Column:
    return F.last_day(col(d))


def time_bucket(ts, window_seconds: int) -> Column:
    """``floor(epoch_seconds / window)`` computed exactly on microseconds.

    Integer floor division (also right before 1970, where truncation would not
    be a floor).
    """
    w = int(window_seconds) * 1_000_000
    us = F.unix_micros(col(ts))
    return ((us - F.pmod(us, F.lit(w))) / F.lit(w)).cast("bigint")


def word_count(q) -> Column:
    """Number of words = number of spaces + 1 (empty string -> 1)."""
    q = col(q)
    return (F.length(q) - F.length(F.replace(q, F.lit(" "), F.lit(""))) + 1).cast("int")


def tokenize(q) -> Column:
    """Distinct lower-cased words, split on any Unicode white space."""
    parts = F.split(F.lower(col(q)), r"(?U)\s+")
    return F.array_distinct(F.filter(parts, lambda x: x != F.lit("")))


def slug(q) -> Column:
    """URL slug: lower, non ``[a-z0-9]`` runs -> '-', trimmed, cut, + hash prefix."""
    q = col(q)
    s = F.regexp_replace(F.lower(q), "[^a-z0-9]+", "-")
    s = F.regexp_replace(s, "^-+|-+$", "")
    s = F.when(F.length(s) > SLUG_MAX_LEN,
               F.regexp_replace(F.substring(s, 1, SLUG_MAX_LEN), "-+$", "")).otherwise(s)
    h = F.substring(F.sha2(q, 256), 1, SLUG_HASH_LEN)
    return F.when(s == "", h).otherwise(F.concat(s, F.lit("-"), h))


def derive_salt(key: str) -> str:
    """Salt from a secret key: a 32-character key as it is, else the urlsafe
    base64 text of its sha256 digest. Computed once on the driver."""
    if not key:
        raise ValueError("a non-empty pseudonymisation key is required")
    if len(key) == SALT_KEY_LEN:
        return key
    return base64.urlsafe_b64encode(hashlib.sha256(key.encode()).digest()).decode()


def pseudonymize(username, key: str) -> Column:
    """sha256 hex of salt + username.

    The salt enters as a one-row table, not as a literal: a literal is printed
    in plans and so in event logs, the rows of a table are not."""
    salt = SparkSession.active().createDataFrame([(derive_salt(key),)], "salt string")
    return F.sha2(F.concat(salt.scalar(), col(username)), 256)


def preview(c, n: int) -> Column:
    c = col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def safe_ratio(x, y) -> Column:
    x, y = col(x), col(y)
    return F.when(y > 0, x.cast("double") / y).otherwise(F.lit(0.0))


def spread_label(seconds) -> Column:
    s = col(seconds)
    expr = None
    for bound, label, _ in SPREAD_BUCKETS:
        expr = F.when(s < bound, F.lit(label)) if expr is None else expr.when(s < bound, F.lit(label))
    return expr.otherwise(F.lit(SPREAD_LAST[0]))


def spread_order(seconds) -> Column:
    s = col(seconds)
    expr = None
    for bound, _, order in SPREAD_BUCKETS:
        expr = F.when(s < bound, F.lit(order)) if expr is None else expr.when(s < bound, F.lit(order))
    return expr.otherwise(F.lit(SPREAD_LAST[1]))


def seconds_between(start, end) -> Column:
    return (F.unix_micros(col(end)) - F.unix_micros(col(start))) / F.lit(1_000_000.0)


# ---------------------------------------------------------------------------
# Blacklist globs -> one anchored regular expression
# ---------------------------------------------------------------------------

def parse_blacklist(raw: str | None) -> list[str]:
    """Patterns between commas and line ends, lower-cased: each begins at a
    character that is neither a separator nor white space."""
    return [m.group().rstrip().lower() for m in re.finditer(r"[^\s,][^,\n]*", raw or "")]


_PUNCT = set(string.punctuation)


def _lit_char(ch: str) -> str:
    return "\\" + ch if ch in _PUNCT else ch


def _set_to_regex(body: str, negate: bool) -> str:
    items: list[tuple[str, str]] = []
    i = 0
    while i < len(body):
        if i + 2 < len(body) and body[i + 1] == "-":
            items.append((body[i], body[i + 2]))
            i += 3
        else:
            items.append((body[i], body[i]))
            i += 1
    items = [(lo, hi) for lo, hi in items if lo <= hi]
    if not items:
        # an empty set matches nothing; an empty negated set matches any char
        return "[\\s\\S]" if negate else "[^\\s\\S]"
    parts = "".join(_lit_char(lo) if lo == hi else _lit_char(lo) + "-" + _lit_char(hi)
                    for lo, hi in items)
    return "[" + ("^" if negate else "") + parts + "]"


def glob_to_regex(pattern: str) -> str:
    """Shell glob (``*``, ``?``, ``[seq]``, ``[!seq]``) as a regex body.

    An unterminated ``[`` is a literal; ``]`` right after ``[`` or ``[!`` is a
    member of the set. All other characters match themselves.
    """
    out, i, n = [], 0, len(pattern)
    while i < n:
        ch = pattern[i]
        i += 1
        if ch == "*":
            if not out or out[-1] != ".*":
                out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[":
            j = i
            if j < n and pattern[j] == "!":
                j += 1
            if j < n and pattern[j] == "]":
                j += 1
            while j < n and pattern[j] != "]":
                j += 1
            if j >= n:
                out.append("\\[")
            else:
                body = pattern[i:j]
                negate = body.startswith("!")
                out.append(_set_to_regex(body[1:] if negate else body, negate))
                i = j + 1
        else:
            out.append(_lit_char(ch))
    return "".join(out)


def blacklist_regex(patterns: list[str]) -> str | None:
    """One anchored, dot-all regex matching any of the globs; None if empty."""
    if not patterns:
        return None
    body = "|".join("(?:" + glob_to_regex(p) + ")" for p in patterns)
    return "(?s)\\A(?:" + body + ")\\z"


def is_blacklisted(q, patterns: list[str]) -> Column:
    """True when lower(q) matches one of the globs as a whole string."""
    rx = blacklist_regex([p.lower() for p in patterns])
    if rx is None:
        return F.lit(False)
    return F.lower(col(q)).rlike(rx)

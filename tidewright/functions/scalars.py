"""Scalar rules: ages, dialects, back-off, stable ids."""

from __future__ import annotations

import email.utils
import math
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sub-dialects and the dialects that they belong to.
SUB_DIALECTS = {
    "midtøstjysk": "Østjysk", "østjysk": "Østjysk", "amagermål": "Københavnsk", "nørrejysk": "Nordjysk", "vestjysk": "Vestjysk", "nordsjællandsk": "Sjællandsk", "sjællandsk": "Sjællandsk",
    "fynsk": "Fynsk", "bornholmsk": "Bornholmsk", "sønderjysk": "Sønderjysk", "vendsysselsk (m. hanherred og læsø)": "Nordjysk", "østligt sønderjysk (m. als)": "Sønderjysk",
    "nordvestsjællandsk": "Sjællandsk", "thybomål": "Vestjysk", "himmerlandsk": "Nordjysk", "djurslandsk (nord-, syddjurs m. nord- og sydsamsø, anholt)": "Østjysk",
    "sydsjællandsk (sydligt sydsjællandsk)": "Sjællandsk", "sydfynsk": "Fynsk", "morsingmål": "Vestjysk", "sydøstjysk": "Østjysk", "østsjællandsk": "Sjællandsk",
    "syd for rigsgrænsen: mellemslesvisk, angelmål, fjoldemål": "Sønderjysk", "vestfynsk (nordvest-, sydvestfynsk)": "Fynsk", "vestlig sønderjysk (m. mandø og rømø)": "Sønderjysk",
    "sydvestjysk (m. fanø)": "Vestjysk", "sallingmål": "Vestjysk", "nordfalstersk": "Sydømål", "langelandsk": "Fynsk", "sydvestsjællandsk": "Sjællandsk", "lollandsk": "Sydømål", "sydømål": "Sydømål",
    "ommersysselsk": "Østjysk", "sydfalstersk": "Sydømål", "fjandbomål": "Vestjysk",
}


def age_group(age: Column) -> Column:
    """0-25, 25-50 (25 included) or 50+; null for null, negative and NaN."""
    return F.when((age < 0) | F.isnan(age.cast("double")), None).when(age < 25, "0-25").when(age < 50, "25-50").when(age >= 50, "50+")


def dialect(sub_dialect: Column, country_birth: Column, table: Mapping[str, str] = SUB_DIALECTS) -> Column:
    """The dialect of a sub-dialect, null if unknown; "Non-native" for those born elsewhere; no country counts as DK."""
    known = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.when(F.coalesce(country_birth, F.lit("DK")) != "DK", "Non-native").otherwise(F.try_element_at(known, sub_dialect))


def retry_delay(n: Column, base: float = 1.0, most: float = 300.0) -> Column:
    """Bounded exponential back-off before retry n (from 0), without jitter."""
    top = math.ceil(math.log2(most / base))
    return F.least(F.lit(float(most)), F.lit(float(base)) * F.pow(F.lit(2.0), F.least(n, F.lit(top))))


def retry_after(value: str | None, now: float, fallback: float = 120.0, most: float = 300.0) -> float:
    """Seconds to wait by a Retry-After header, a number or an HTTP date, at most ``most``; a number below 0 counts as none."""
    seconds = None
    try:
        seconds = float(value or "")
        seconds = seconds if seconds >= 0 else None
    except ValueError:
        date = email.utils.parsedate_tz(value or "")
        seconds = max(0.0, email.utils.mktime_tz(date) - now) if date else None
    return min(most, seconds) if seconds is not None and math.isfinite(seconds) else min(most, fallback)


def is_retryable(status: Column) -> Column:
    return status.isin(408, 429, 499) | status.between(500, 599)


def cue_id(path: Column, start: Column, end: Column, text: Column) -> Column:
    """The first 24 hexadecimals of the SHA-256 of path, times to three places and text, joined by NUL."""
    return F.substring(F.sha2(F.concat_ws("\u0000", path, F.format_string("%.3f", start), F.format_string("%.3f", end), text), 256), 1, 24)

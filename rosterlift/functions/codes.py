"""Code lists: exact maps, pattern maps, ranges and the country list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col, text

# Upper ends of the head-count ranges.
HEADCOUNT_RANGES = ((10, "1-10"), (50, "11-50"), (200, "51-200"), (500, "201-500"), (1000, "501-1000"),
                    (5000, "1001-5000"), (10000, "5001-10000"))

# Country ids of one vendor.
COUNTRIES = {
    0: "United States", 1: "United States", 2186: "Albania", 2188: "Andorra", 2192: "United Kingdom",
    2193: "Armenia", 2194: "Australia", 2195: "Austria", 2197: "Bahamas", 2199: "Bangladesh", 2201: "Belarus",
    2202: "Belgium", 2207: "Bosnia", 2209: "Brazil", 2211: "Bulgaria", 2216: "Canada", 2220: "Chile", 2221: "China",
    2222: "Colombia", 2230: "Cyprus", 2231: "Czech Republic", 2232: "Denmark", 2237: "Egypt", 2241: "Estonia",
    2244: "Finland", 2245: "France", 2248: "Georgia", 2249: "Germany", 2250: "Ghana", 2251: "Greece",
    2260: "Hungary", 2261: "Iceland", 2262: "India", 2263: "Indonesia", 2266: "United Kingdom", 2267: "Israel",
    2268: "Italy", 2270: "Japan", 2272: "Kazakhstan", 2275: "South Korea", 2279: "Latvia", 2285: "Lithuania",
    2286: "Luxembourg", 2291: "Malaysia", 2293: "Malta", 2296: "Mexico", 2299: "Monaco", 2301: "Morocco",
    2306: "Netherlands", 2307: "New Zealand", 2311: "Norway", 2313: "Pakistan", 2319: "Philippines", 2320: "Poland",
    2321: "Portugal", 2322: "Qatar", 2323: "Romania", 2324: "Russia", 2328: "Saudi Arabia", 2333: "United Kingdom",
    2334: "Slovakia", 2335: "Slovenia", 2338: "South Africa", 2339: "Spain", 2340: "Sri Lanka", 2344: "Sweden",
    2345: "Switzerland", 2350: "Thailand", 2354: "Turkey", 2357: "Ukraine", 2358: "United Arab Emirates",
    2359: "United Kingdom", 2360: "Uruguay", 2364: "Vietnam", 2374: "Puerto Rico", 2375: "Taiwan",
    2377: "Hong Kong", 2379: "Cayman Islands", 2395: "Moldova", 2402: "Serbia", 2436: "South Korea",
}


def code_map(value: ColumnLike, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """A fixed code list as one map lookup."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), as_col(value))
    return found if default is None else F.coalesce(found, F.lit(default))


def code_groups(value: ColumnLike, groups: Mapping[str, Sequence[str]], default: str | None = None) -> Column:
    """Status text, trimmed and lower-cased, mapped to the first group that lists it."""
    flat: dict[str, str] = {}
    for result, codes in groups.items():
        for code in codes:
            flat.setdefault(code.lower(), result)
    return code_map(F.lower(F.trim(text(value))), flat, default)


def first_pattern(value: ColumnLike, patterns: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """The result of the first LIKE pattern the text matches, whatever its case."""
    v = text(value)
    out = F.when(v.ilike(patterns[0][0]), patterns[0][1])
    for pattern, result in patterns[1:]:
        out = out.when(v.ilike(pattern), result)
    return out.otherwise(F.lit(default))


def headcount_range(value: ColumnLike) -> Column:
    n = as_col(value)
    out = F.when(n.isNull() | (n == 0), F.lit(None))
    for top, label in HEADCOUNT_RANGES:
        out = out.when(n <= top, label)
    return out.otherwise("10000+")


def country_name(value: ColumnLike) -> Column:
    return code_map(as_col(value).cast("int"), COUNTRIES)


def stage_from_dates(stages: Sequence[tuple[str, Sequence[ColumnLike]]], default: str) -> Column:
    """The first stage with any of its dates filled; stages are listed furthest first."""
    out = None
    for stage, dates in stages:
        reached = F.coalesce(*[as_col(d) for d in dates]).isNotNull()
        out = F.when(reached, stage) if out is None else out.when(reached, stage)
    return out.otherwise(default)

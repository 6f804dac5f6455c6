"""Device, operating system and browser from a user-agent text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. Rules are (label, words that must occur, words that must not occur); the first match wins.
DEVICE_RULES = (
    ("tablet", ["ipad"], []),
    ("mobile", ["iphone"], []),
    ("mobile", ["android", "mobile"], []),
    ("tablet", ["android"], []),
    ("mobile", ["mobile"], []),
    ("desktop", ["windows"], []),
    ("desktop", ["macintosh"], []),
    ("desktop", ["x11"], []),
)
OS_RULES = (
    ("iOS", ["iphone"], []),
    ("iOS", ["ipad"], []),
    ("Android", ["android"], []),
    ("Windows", ["windows nt"], []),
    ("MacOS", ["mac os x"], ["iphone"]),
    ("Linux", ["linux"], []),
)
BROWSER_RULES = (
    ("Chrome (iOS)", ["crios"], []),
    ("Firefox (iOS)", ["fxios"], []),
    ("Edge (iOS)", ["edgios"], []),
    ("Chrome", ["chrome"], ["edg"]),
    ("Safari", ["safari"], ["chrome"]),
    ("Firefox", ["firefox"], []),
    ("Edge", ["edg"], []),
)
DEVICES = ("desktop", "mobile", "tablet", "unknown")


def _label(user_agent: Column, rules, default: str) -> Column:
    agent = F.lower(user_agent)
    label = F.lit(default)
    for name, present, absent in reversed(rules):
        tests = [F.contains(agent, F.lit(word)) for word in present]
        tests += [~F.contains(agent, F.lit(word)) for word in absent]
        label = F.when(reduce(Column.__and__, tests), F.lit(name)).otherwise(label)
    return label


def device_type(user_agent: Column) -> Column:
    return _label(user_agent, DEVICE_RULES, "unknown")


def operating_system(user_agent: Column) -> Column:
    return _label(user_agent, OS_RULES, "Other")


def browser(user_agent: Column) -> Column:
    return _label(user_agent, BROWSER_RULES, "Other")

"""Rules on metric ids: exclusion reasons, plausibility ceilings, display labels, globs."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Exclusion:
    """Why a metric id is left out. Every part that is given must hold."""

    reason: str
    suffixes: tuple[str, ...] = ()
    prefix: str | None = None
    ids: tuple[str, ...] = ()
    unit_class: str | None = None

    def holds(self, sid: Column, unit_class: Column) -> Column:
        test = F.lit(True)
        if self.suffixes:
            any_suffix = F.lit(False)
            for suffix in self.suffixes:
                any_suffix = any_suffix | sid.endswith(suffix)
            test = test & any_suffix
        if self.prefix:
            test = test & sid.startswith(self.prefix)
        if self.ids:
            test = test & sid.isin(*self.ids)
        if self.unit_class:
            test = test & unit_class.eqNullSafe(self.unit_class)
        return test


# Id patterns, reasons, devices with a lifetime meter, ceilings in kW, device
# families, label suffixes in the order they are stripped, reviewed names.
MONTHLY_DUPLICATE = Exclusion("monthly cycle duplicate; daily cycle is the finer-grained source",
                              suffixes=("_this_month_s_consumption",))
DAILY_SUFFIX = "_today_s_consumption"
LIFETIME_DEVICES = ("g1", "p1", "p2", "p3", "schoolhouse", "schoolhouse_blue")
OTHER_EXCLUSIONS = (
    Exclusion("opower-derived billing sensor; canonical series is opower:*_energy_consumption",
              prefix="sensor.elec_account_"),
    Exclusion("all-zero across 5020 rows (max_sum=0.0); no solar export on this account",
              suffixes=("_energy_return",)),
    Exclusion("monthly cycle over the same source as sensor.computer_today_s_consumption",
              ids=("sensor.computer_energy_this_month_wh", "sensor.eve_monthly_cycle")),
    Exclusion("1-row artifact of a renamed integration; no usable history",
              prefix="sensor.pi5_", unit_class="temperature"),
    Exclusion("USD cost/compensation, not energy; out of scope for this phase",
              suffixes=("_energy_cost", "_energy_compensation")),
)
IMPORTED_PREFIX = "opower:"
CEILING_HOME_KW, CEILING_BULB_KW, CEILING_OUTLET_KW = 25.0, 0.05, 2.0
BULB_FAMILIES = ("r1_", "r2_", "r3_", "aqara_lumi_light")
LABEL_SUFFIXES = ("_today_s_consumption", "_total_consumption", "_summation_delivered",
                  "_current_consumption", "_instantaneous_demand", "_temperature", "_power")


def exclusion_reason(sid: Column, unit_class: Column) -> Column:
    """The first rule that holds; NULL means nobody has reviewed the metric."""
    device = F.regexp_extract(sid, f"^.{{{len('sensor.')}}}(.*){DAILY_SUFFIX}$", 1)
    daily = (F.when(device.isin(*LIFETIME_DEVICES),
                    F.concat(F.lit("superseded by sensor."), device,
                             F.lit("_total_consumption (lifetime meter)")))
              .otherwise("unreviewed daily cycle sensor"))
    chain = (F.when(MONTHLY_DUPLICATE.holds(sid, unit_class), MONTHLY_DUPLICATE.reason)
              .when(sid.endswith(DAILY_SUFFIX), daily))
    for rule in OTHER_EXCLUSIONS:
        chain = chain.when(rule.holds(sid, unit_class), rule.reason)
    return chain


def ceiling_kw(sid: Column) -> Column:
    """Highest sustained power a metric can plausibly report, by source and device family."""
    bulb = F.lit(False)
    for family in BULB_FAMILIES:
        bulb = bulb | sid.contains(family)
    return (F.when(sid.startswith(IMPORTED_PREFIX), CEILING_HOME_KW)
             .when(bulb, CEILING_BULB_KW).otherwise(CEILING_OUTLET_KW))


def label_base(sid: Column) -> Column:
    """The id without its domain and without the known suffixes, each stripped once in order."""
    base = F.regexp_replace(sid, r"^[^.]*\.", "")
    for suffix in LABEL_SUFFIXES:
        base = F.regexp_replace(base, f"{re.escape(suffix)}$", "")
    return base


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda run: F.concat(
        F.upper(F.substring(run, 1, 1)), F.lower(F.substr(run, F.lit(2))))), "")


def title_slug(base: Column) -> Column:
    return title_case(F.replace(base, F.lit("_"), F.lit(" ")))


def glob_regex(glob: str) -> str:
    """Anchored regular expression of a shell-style glob (* and ?)."""
    return "^" + "".join({"*": ".*", "?": "."}.get(ch, re.escape(ch)) for ch in glob) + "$"

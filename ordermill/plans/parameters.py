"""Parameter domains of the queries, for drawing many different runs of each."""

from __future__ import annotations

import random
import string
from dataclasses import dataclass, field
from datetime import date, timedelta

from ordermill.synth.tables import NATIONS, REGIONS

LOWER = string.ascii_lowercase


@dataclass(frozen=True)
class Domains:
    """What parameters are drawn from: the values differ between data sets, the rules do not.

    ``first_year``: the first year of order dates. The defaults are the document data set's.
    """

    first_year: int = 2014
    regions: tuple[str, ...] = ("Africa", "America", "Asia", "Europe", "Middle East")
    share_region: str = "Europe"
    share_nations: tuple[str, ...] = tuple(name for _, name, region in NATIONS if REGIONS[region] == "Europe")
    nations: tuple[str, ...] = tuple(name for _, name, _ in NATIONS)
    state_characters: str = LOWER + string.ascii_uppercase + string.digits
    warehouses: int = 100
    total_range: tuple[int, int] = (200, 300)
    late_days: int = 150
    promo_prefixes: tuple[str, ...] = ("pr",)
    extra: dict = field(default_factory=dict)


def _day(year: int, month: int = 1, day: int = 1) -> str:
    return f"{year}-{month:02d}-{day:02d} 00:00:00"


def draw(name: str, domains: Domains, seed: int) -> dict:
    """Parameters of one query, drawn from its domain. The same seed draws the same values."""
    rng = random.Random(f"{name}/{seed}")
    y = domains.first_year

    def letter() -> str:
        return rng.choice(LOWER)

    def pair() -> str:
        return letter() + letter()

    order_year = rng.randint(y + 1, y + 5)
    month = rng.randint(1, 12)
    nation = rng.choice(domains.nations) if domains.nations else "Germany"

    if name == "q01":
        days = rng.randint(180, 240)
        start = date(y, 1, 1) + timedelta(days=days)
        return {"since": f"{start} 00:00:00"}
    if name == "q02":
        return {"region": rng.choice(domains.regions) + "%", "suffix": letter()}
    if name == "q03":
        middle_year = (y + y + 6) // 2
        return {"state": rng.choice(domains.state_characters), "before": _day(middle_year, 3, rng.randint(1, 31)), "limit": 10}
    if name == "q04":
        return {"start": _day(order_year, month)}
    if name == "q05":
        return {"region": rng.choice(domains.regions), "year": order_year}
    if name == "q06":
        return {"year": order_year, "min_amount": float(rng.randint(500, 700))}
    if name == "q07":
        a, b = rng.sample(domains.nations, 2)
        return {"nation_a": a, "nation_b": b, "first": _day(y + 3), "last": _day(y + 4, 12, 31)}
    if name == "q08":
        return {"region": domains.share_region, "nation": rng.choice(domains.share_nations), "suffix": letter(),
                "first": _day(y + 3), "last": _day(y + 4, 12, 31)}
    if name == "q09":
        return {"suffix": pair()}
    if name == "q10":
        return {"start": _day(rng.randint(y + 1, y + 3), month)}
    if name == "q11":
        return {"nation": nation, "fraction": domains.extra.get("fraction", 0.00005)}
    if name == "q12":
        return {"year": order_year}
    if name == "q13":
        return {"carrier_above": rng.randint(5, 10)}
    if name == "q14":
        return {"start": _day(order_year, month), "prefix": rng.choice(domains.promo_prefixes)}
    if name == "q15":
        return {"start": _day(order_year, month)}
    if name == "q16":
        return {"not_prefix": pair()}
    if name == "q17":
        return {"suffix": letter()}
    if name == "q18":
        return {"total_above": float(rng.randint(*domains.total_range))}
    if name == "q19":
        places = [rng.randint(1, domains.warehouses) for _ in range(9)]
        starts = [rng.randint(1, 10), rng.randint(10, 20), rng.randint(20, 30)]
        prices = domains.extra.get("prices", (5.0, 10.0, 15.0))
        return {"branches": tuple(
            (letter(), starts[n], starts[n] + 10, prices[n], tuple(places[3 * n: 3 * n + 3])) for n in range(3)
        )}
    if name == "q20":
        return {"prefix": rng.choice(domains.extra.get("prefixes", [pair()])), "nation": nation, "start": _day(order_year)}
    if name in ("q21", "q21_lines"):
        year = rng.randint(y, y + 6)
        first_month = domains.extra.get("late_from_month", 12)
        return {"nation": nation, "first": _day(year, first_month), "last": _day(year, 12, 31), "days": domains.late_days}
    if name == "q22":
        # Two lists of seven out of 1..10; a ten never equals one character.
        chosen, averaged = (tuple(str(n) for n in rng.sample(range(1, 11), 7)) for _ in range(2))
        return {"digits": chosen, "average_digits": averaged, "idle": domains.extra.get("idle")}
    raise KeyError(name)

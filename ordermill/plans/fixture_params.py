"""Parameters that suit the given tables: years 1995-2001, their nation and region names."""

from ordermill.plans.parameters import Domains

FIXTURE_PARAMS = {
    "q01": {"since": "1995-07-01 00:00:00"},
    "q02": {"region": "EUROP%", "suffix": "b"},
    "q03": {"state": "a", "before": "1998-03-15 00:00:00"},
    "q04": {"start": "1996-07-01 00:00:00"},
    "q05": {"region": "ASIA", "year": 1997},
    "q06": {"year": 1997, "min_amount": 600.0},
    "q07": {"nation_a": "NATION_7", "nation_b": "NATION_9", "first": "1998-01-01 00:00:00", "last": "1999-12-31 00:00:00"},
    "q08": {"region": "EUROPE", "nation": "NATION_7", "suffix": "b", "item_below": 1000,
            "first": "1998-01-01 00:00:00", "last": "1999-12-31 00:00:00"},
    "q09": {"suffix": "bb"},
    "q10": {"start": "1996-10-01 00:00:00"},
    "q11": {"nation": "NATION_7", "fraction": 0.005},
    "q12": {"year": 1997},
    "q13": {"carrier_above": 8},
    "q14": {"start": "1998-09-01 00:00:00", "prefix": "pr"},
    "q15": {"start": "1999-01-01 00:00:00"},
    "q16": {"not_prefix": "sm"},
    "q17": {"suffix": "b"},
    "q18": {"total_above": 300000.0},
    "q19": {"branches": (("h", 7, 17, 50.0, (1, 2)), ("t", 16, 26, 60.0, (2, 3)), ("m", 24, 34, 70.0, (3, 4)))},
    "q20": {"prefix": "ec", "nation": "NATION_7", "start": "1997-01-01 12:00:00"},
    "q21": {"nation": "NATION_7", "first": "1998-01-01 00:00:00", "last": "1998-12-31 00:00:00", "days": 100},
    "q21_lines": {"nation": "NATION_7", "first": "1998-01-01 00:00:00", "last": "1998-12-31 00:00:00", "days": 100},
    "q22": {"digits": ("1", "2", "3"), "idle": ("1998-01-01 00:00:00", "1998-06-30 00:00:00")},
}

FIXTURE_DOMAINS = Domains(
    first_year=1995,
    regions=("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    share_region="EUROPE",
    share_nations=("NATION_3", "NATION_8", "NATION_13", "NATION_18", "NATION_23"),
    nations=tuple(f"NATION_{n}" for n in range(25)),
    state_characters="abcdefghijklmnopqrstuvwxy",
    warehouses=4,
    total_range=(300_000, 400_000),
    late_days=100,
    promo_prefixes=("pr", "sm", "la"),
    extra={"fraction": 0.005, "prices": (50.0, 60.0, 70.0), "prefixes": ["ec", "st", "la", "pr", "me"], "late_from_month": 1,
           "idle": ("1998-01-01 00:00:00", "1998-06-30 00:00:00")},
)

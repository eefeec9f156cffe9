"""All analytical queries by name."""

from __future__ import annotations

from ordermill.plans import market, pricing, supply

ANALYTIC = {
    "q01": pricing.q01, "q02": supply.q02, "q03": market.q03, "q04": pricing.q04, "q05": market.q05,
    "q06": pricing.q06, "q07": market.q07, "q08": market.q08, "q09": market.q09, "q10": market.q10,
    "q11": supply.q11, "q12": pricing.q12, "q13": pricing.q13, "q14": pricing.q14, "q15": supply.q15,
    "q16": supply.q16, "q17": pricing.q17, "q18": pricing.q18, "q19": pricing.q19, "q20": supply.q20,
    "q21": supply.q21, "q21_lines": supply.q21_lines, "q22": market.q22,
}

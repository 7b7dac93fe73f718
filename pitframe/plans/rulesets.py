"""The two shipped rule sets as data: Spark SQL expressions over feature names, with the features each one reads.

Thresholds, weights and sector lists are fixed values of the rule sets. Parameters in braces are supplied by a run.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Gate:
    code: str
    expr: str
    reads: tuple[str, ...]
    unknown_blocks: bool = True


@dataclass(frozen=True)
class Exit:
    code: str
    expr: str
    reads: tuple[str, ...]
    on_out_of_domain: str = "fire"
    cadence: str = "daily"
    weekday: str | None = None  # of a weekly exit

    def __post_init__(self):
        if self.cadence not in ("daily", "weekly") or (self.cadence == "weekly") != (self.weekday is not None):
            raise ValueError(f"exit {self.code}: a weekly cadence needs a weekday, a daily one has none")


@dataclass(frozen=True)
class Composite:
    name: str
    inputs: tuple[tuple[str, str], ...]  # (feature, direction)
    min_inputs_known: int


@dataclass(frozen=True)
class RuleSet:
    name: str
    features: tuple[str, ...]
    unknown: dict[str, str]  # feature -> fail | penalise; anything else is exclude
    exclude_sectors: tuple[str, ...]
    filters: tuple[Gate, ...]
    gates: tuple[Gate, ...]
    z_terms: tuple[tuple[str, str], ...]  # (feature, weight)
    composites: tuple[Composite, ...]
    composite_weights: tuple[tuple[str, str], ...]
    size_checks: tuple[Gate, ...]
    sizing: str
    entry_high_factor: str
    quantity_limits: tuple[str, ...]
    tranche_weights: tuple[str, ...]
    exits: tuple[Exit, ...]
    capacity_order: str = "rank"
    selection: str = "rank_and_gate"
    stop_multiple: float | None = None
    entry_weekday: str | None = None  # evaluated once a week, up to this weekday; else on every session
    params: dict[str, str] = field(default_factory=dict)

    def behaviour(self, feature: str) -> str:
        return self.unknown.get(feature, "exclude")

    def ranking_inputs(self) -> tuple[str, ...]:
        names = [f for f, _ in self.z_terms] + [f for c in self.composites for f, _ in c.inputs]
        return tuple(dict.fromkeys(names))


HIGH_SURVEILLANCE = "surveillance_stage IN ('asm_lt_2plus', 'asm_st_2plus', 'gsm_any')"

MOMENTUM = RuleSet(
    name="momentum",
    features=(
        "ret_12m_skip_1m", "ret_6m_skip_1m", "realised_vol_60d", "vol_adj_mom_12m", "vol_adj_mom_6m",
        "rel_strength_6m_vs_index", "adv_20d_cr", "delivery_pct_20d_avg", "is_fno_eligible", "price_vs_dma50",
        "price_vs_dma200", "atr_pct_20", "circuit_days_60d", "surveillance_stage", "market_breadth",
    ),
    unknown={"is_fno_eligible": "fail", "surveillance_stage": "fail", "market_breadth": "penalise"},
    exclude_sectors=(),
    filters=(Gate("U1", "circuit_days_60d <= 5", ("circuit_days_60d",)),),
    gates=(
        Gate("G1", "adv_20d_cr >= 25", ("adv_20d_cr",)),
        Gate("G2", "price_vs_dma200 > 1.0 AND price_vs_dma50 > 1.0", ("price_vs_dma200", "price_vs_dma50")),
        Gate("G3", "ret_12m_skip_1m > 0", ("ret_12m_skip_1m",)),
        Gate("G4", "vol_adj_mom_12m >= 0.60", ("vol_adj_mom_12m",)),
        Gate("G5", "rel_strength_6m_vs_index >= 0.05", ("rel_strength_6m_vs_index",)),
        Gate("G6", "delivery_pct_20d_avg >= if(is_fno_eligible, {band_fno}, {band_cash})",
             ("delivery_pct_20d_avg", "is_fno_eligible")),
        Gate("G7", "surveillance_stage = 'none'", ("surveillance_stage",)),
    ),
    z_terms=(("vol_adj_mom_12m", "0.60"), ("vol_adj_mom_6m", "0.40")),
    composites=(),
    composite_weights=(),
    size_checks=(
        Gate("S1", "impact_cost <= 0.0035", ("adv_20d_cr",)),
        Gate("S2", "value_cr <= 0.10 * adv_20d_cr", ("adv_20d_cr",)),
    ),
    sizing="{notional_capital} * {risk_to_stop_pct} / (2.5 * atr_pct_20)",
    entry_high_factor="1.03",
    quantity_limits=("({notional_capital} * {risk_to_stop_pct}) div (entry_high * 2.5 * atr_pct_20)",),
    tranche_weights=("1.0",),
    exits=(
        Exit("X1", "close < stop_in_force", ()),
        Exit("X2", "below_dma50_3_sessions", ("price_vs_dma50",)),
        Exit("X3", "vol_adj_mom_12m < 0.30", ("vol_adj_mom_12m",), cadence="weekly", weekday="fri"),
        Exit("X4", "holding_days >= 180", ()),
        Exit("X5", HIGH_SURVEILLANCE, ("surveillance_stage",)),
    ),
    stop_multiple=2.5,
    entry_weekday="fri",
)

QUALITY_VALUE = RuleSet(
    name="quality_value",
    features=(
        "operating_history_years", "roce_3y_avg", "roce_hy_ttm", "roce_5y_trend", "roce_stability", "cfo_pat_3y",
        "debt_equity", "interest_coverage", "positive_revenue_growth_years_5y", "exceptional_frequency",
        "earnings_yield_ttm", "ey_median_5y", "ey_vs_own_5y_median", "ev_ebitda_vs_sector", "earnings_yield_spread",
        "realised_vol_1y", "promoter_pledge_pct", "auditor_resignation_5y", "forensic_flag_count",
        "forensic_coverage_pct", "surveillance_stage",
    ),
    unknown={
        "roce_stability": "penalise", "positive_revenue_growth_years_5y": "penalise",
        "exceptional_frequency": "penalise", "ev_ebitda_vs_sector": "penalise", "earnings_yield_spread": "penalise",
        "promoter_pledge_pct": "fail", "auditor_resignation_5y": "fail", "forensic_flag_count": "fail",
        "forensic_coverage_pct": "fail", "surveillance_stage": "fail",
    },
    exclude_sectors=(
        "banks", "nbfc", "insurance", "capital_markets", "metals_mining", "cement", "commodity_chemicals", "sugar",
        "oil_gas_upstream", "shipping",
    ),
    filters=(),
    gates=(
        Gate("G1", "operating_history_years >= 7", ("operating_history_years",)),
        Gate("G2", "roce_3y_avg >= 0.15", ("roce_3y_avg",)),
        Gate("G3", "cfo_pat_3y >= 0.70", ("cfo_pat_3y",)),
        Gate("G4", "interest_coverage >= 2.5 AND (debt_equity <= 1.0 OR interest_coverage >= 6)",
             ("interest_coverage", "debt_equity")),
        Gate("G5", "promoter_pledge_pct <= 0.15", ("promoter_pledge_pct",)),
        Gate("G6", "auditor_resignation_5y = false", ("auditor_resignation_5y",)),
        Gate("G7", "forensic_flag_count <= 1 AND forensic_coverage_pct >= 0.75",
             ("forensic_flag_count", "forensic_coverage_pct")),
        Gate("G8", "surveillance_stage = 'none'", ("surveillance_stage",)),
        Gate("G9", "earnings_yield_ttm > 0 AND ey_median_5y > 0 AND ey_vs_own_5y_median >= 1.0",
             ("earnings_yield_ttm", "ey_median_5y", "ey_vs_own_5y_median")),
    ),
    z_terms=(),
    composites=(
        Composite("quality_composite", (
            ("roce_3y_avg", "higher_better"), ("roce_5y_trend", "higher_better"), ("cfo_pat_3y", "higher_better"),
            ("debt_equity", "lower_better"), ("interest_coverage", "higher_better")), 5),
        Composite("value_composite", (
            ("ey_vs_own_5y_median", "higher_better"), ("ev_ebitda_vs_sector", "lower_better"),
            ("earnings_yield_spread", "higher_better")), 2),
        Composite("consistency_composite", (
            ("roce_stability", "higher_better"), ("positive_revenue_growth_years_5y", "higher_better"),
            ("exceptional_frequency", "lower_better")), 2),
    ),
    composite_weights=(("quality_composite", "0.50"), ("value_composite", "0.30"), ("consistency_composite", "0.20")),
    size_checks=(),
    sizing="{notional_capital} * {target_vol_contribution} / realised_vol_1y",
    entry_high_factor="1.05",
    quantity_limits=(),
    tranche_weights=("0.3334", "0.3333", "0.3333"),
    exits=(
        Exit("X1", "roce_hy_ttm_low_2_half_years", ("roce_hy_ttm",)),
        Exit("X2", "cfo_pat_3y < 0.50", ("cfo_pat_3y",)),
        Exit("X3", "ey_vs_own_5y_median <= 0.57 AND roce_5y_trend <= 0", ("ey_vs_own_5y_median", "roce_5y_trend")),
        Exit("X4", "promoter_pledge_pct > 0.25 OR auditor_resignation_5y = true",
             ("promoter_pledge_pct", "auditor_resignation_5y")),
        Exit("X5", HIGH_SURVEILLANCE, ("surveillance_stage",)),
    ),
)

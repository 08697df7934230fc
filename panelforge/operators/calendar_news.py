"""Calendar events ahead of a day and news behind it: range joins by exploding to the days or windows they meet."""

from __future__ import annotations

from panelforge.plans.recipe import Recipe, case, listed, lookup, rounded

#: Event types by alias, impacts by alias.
EVENT_TYPES = {
    "EMPLOYMENT": "JOBS", "NONFARM_PAYROLLS": "JOBS", "NFP": "JOBS", "FOMC": "FED", "RATE_DECISION": "FED", "CPI_RELEASE": "CPI",
    "PCE": "INFLATION", "INFLATION": "INFLATION", "AUCTION": "TREASURY_AUCTION", "OPEX_EXPIRY": "OPEX", "HALF_DAY": "HOLIDAY", "CLOSE_DUE_TO_HOLIDAY": "HOLIDAY",
}
IMPACTS = {"LOW": "LOW", "MED": "MEDIUM", "MEDIUM": "MEDIUM", "MODERATE": "MEDIUM", "HIGH": "HIGH", "CRITICAL": "HIGH", "EXTREME": "EXTREME"}
LOOKAHEAD = 10


def _alias(column: str, table: dict) -> str:
    return lookup(column, {k: f"'{v}'" for k, v in table.items()}, column)


def state_text(column: str) -> str:
    """Upper case, with underscores for blanks and dashes."""
    return f"replace(replace(upper(trim({column})), '-', '_'), ' ', '_')"


NORMAL_EVENTS = Recipe().add(t=state_text("event_type"), i="upper(trim(impact))").pick("event_id", "event_date", event_type=_alias("t", EVENT_TYPES), impact=_alias("i", IMPACTS))
#: Each event on every day whose lookahead reaches it.
EVENT_WINDOWS = NORMAL_EVENTS.add(
    back=("explode(sequence(0, %d))" % LOOKAHEAD, "unnest(range(0, %d))" % (LOOKAHEAD + 1)),
).add(observation_date=("date_sub(event_date, back)", "event_date - CAST(back AS INTEGER)"))
#: Event types by the name of their count.
_COUNTS = {"fed": ["FED"], "cpi": ["CPI"], "jobs": ["JOBS"], "opex": ["OPEX"], "earnings": ["EARNINGS"], "holiday": ["HOLIDAY"], "auction": ["TREASURY_AUCTION"],
           "macro": ["FED", "CPI", "PPI", "JOBS", "GDP", "TREASURY_AUCTION"], "inflation": ["CPI", "PPI", "INFLATION"]}
EVENT_DAYS = (
    EVENT_WINDOWS.group(
        ["observation_date"],
        events="count(*)",
        **{f"{n}_events": "count(CASE WHEN event_type IN (" + ", ".join(f"'{x}'" for x in t) + ") THEN 1 END)" for n, t in _COUNTS.items()},
        high_events="count(CASE WHEN impact = 'HIGH' THEN 1 END)",
        next_high=("min(CASE WHEN impact = 'HIGH' THEN struct(event_date, event_id) END).event_id", "arg_min(event_id, CAST(event_date AS VARCHAR) || event_id) FILTER (impact = 'HIGH')"),
        next_high_date="min(CASE WHEN impact = 'HIGH' THEN event_date END)",
        score="sum(CASE impact WHEN 'HIGH' THEN CAST(3 AS DOUBLE) WHEN 'MEDIUM' THEN CAST(1.5 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END + CASE WHEN event_type IN ('FED', 'CPI', 'PPI', 'JOBS', 'GDP', 'TREASURY_AUCTION', 'OPEX') THEN CAST(0.75 AS DOUBLE) WHEN event_type = 'HOLIDAY' THEN CAST(0.2 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)",
    )
    .add(event_risk_score=rounded("score", 3), days_to_high=("datediff(next_high_date, observation_date)", "date_diff('day', observation_date, next_high_date)"))
    .add(
        event_risk=case(
            ("high_events = 0 AND event_risk_score <= 0.5", "NO_MAJOR_EVENTS"),
            ("event_risk_score < 3", "LOW_EVENT_RISK"),
            ("event_risk_score < 7", "MODERATE_EVENT_RISK"),
            ("event_risk_score < 12", "HIGH_EVENT_RISK"),
            default="EXTREME_EVENT_RISK",
        )
    )
)
EVENT_COLUMNS = ["observation_date", "events", *(f"{n}_events" for n in _COUNTS), "high_events", "next_high", "days_to_high", "event_risk_score", "event_risk"]

#: Third Fridays of the months with any row; a column ``day`` in.
OPEX_DAYS = (
    Recipe()
    .add(month_start=("CAST(date_trunc('month', day) AS DATE)", "CAST(date_trunc('month', day) AS DATE)"))
    .group(["month_start"], rows_in_month="count(*)")
    .add(opex_date=("date_add(next_day(date_sub(month_start, 1), 'Fri'), 14)", "month_start + CAST((12 - isodow(month_start)) % 7 AS INTEGER) + 14"))
)

#: News of the 24 hours up to 16:00 of each day: an article belongs to one such window, or at exactly 16:00 to two.
_WINDOW_END = ("explode(array_distinct(array(CAST(published_at + INTERVAL '8' HOUR - INTERVAL '1' MICROSECOND AS DATE), CAST(published_at + INTERVAL '8' HOUR AS DATE))))", "unnest(list_distinct([CAST(published_at + INTERVAL 8 HOUR - INTERVAL 1 MICROSECOND AS DATE), CAST(published_at + INTERVAL 8 HOUR AS DATE)]))")
#: Categories of articles.
CATEGORIES = ("MACRO", "FED", "EARNINGS", "COMPANY", "GEOPOLITICAL", "SECTOR", "CREDIT", "VOLATILITY")
NEWS_WINDOWS = Recipe().add(observation_date=_WINDOW_END).add(
    bucket="CASE WHEN sentiment_score >= 0.2 THEN 'POSITIVE' WHEN sentiment_score <= -0.2 THEN 'NEGATIVE' WHEN sentiment_score IS NOT NULL THEN 'NEUTRAL' END",
    kind="CASE WHEN upper(trim(category)) IN (" + ", ".join(f"'{c}'" for c in CATEGORIES) + ") THEN upper(trim(category)) ELSE 'OTHER' END",
    weight="greatest(relevance_score, CAST(0 AS DOUBLE)) * greatest(impact_score, CAST(0 AS DOUBLE))",
    high="coalesce(impact_score >= 0.75, false)",
)
NEWS_DAYS = (
    NEWS_WINDOWS.group(
        ["observation_date"],
        articles="count(*)",
        **{b.lower(): f"count(CASE WHEN bucket = '{b}' THEN 1 END)" for b in ("POSITIVE", "NEGATIVE", "NEUTRAL")},
        **{f"{c.lower()}_news": f"count(CASE WHEN kind = '{c}' THEN 1 END)" for c in (*CATEGORIES, "OTHER")},
        high_impact="count(CASE WHEN high THEN 1 END)",
        high_negative="count(CASE WHEN high AND coalesce(sentiment_score, 0) <= -0.2 THEN 1 END)",
        high_positive="count(CASE WHEN high AND coalesce(sentiment_score, 0) >= 0.2 THEN 1 END)",
        avg_sentiment="avg(sentiment_score)",
        avg_relevance="avg(relevance_score)",
        avg_impact="avg(impact_score)",
        weighted="sum(CASE WHEN sentiment_score IS NOT NULL THEN sentiment_score * weight END) / nullif(sum(CASE WHEN sentiment_score IS NOT NULL THEN weight END), 0)",
    )
    .add(pressure="CASE WHEN weighted IS NOT NULL THEN greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), abs(weighted) * (coalesce(avg_relevance, 0) + coalesce(avg_impact, 0)) / 2)) END")
    .add(
        sentiment_regime=case(
            ("weighted IS NULL", "LOW_SIGNAL_SENTIMENT"),
            ("high_negative > high_positive AND weighted <= -0.2", "HIGH_IMPACT_NEGATIVE"),
            ("high_positive > high_negative AND weighted >= 0.2", "HIGH_IMPACT_POSITIVE"),
            ("weighted >= 0.15", "POSITIVE_SENTIMENT"),
            ("weighted <= -0.15", "NEGATIVE_SENTIMENT"),
            ("abs(weighted) < 0.1 AND articles <= 2", "LOW_SIGNAL_SENTIMENT"),
            default="MIXED_SENTIMENT",
        )
    )
)
NEWS_COLUMNS = ["observation_date", "articles", "positive", "negative", "neutral", *(f"{c.lower()}_news" for c in (*CATEGORIES, "OTHER")), "high_impact", "high_negative", "high_positive", "avg_sentiment", "avg_relevance", "avg_impact", "weighted", "pressure", "sentiment_regime"]
#: The five symbols of most relevance in each window, ties to the article met first.
TOP_SYMBOLS = (
    NEWS_WINDOWS.group(["observation_date", "symbol"], relevance="sum(coalesce(relevance_score, 0))", first_seen="min(published_at)")
    .add(total=rounded("relevance"))
    .add(place="row_number() OVER (PARTITION BY observation_date ORDER BY total DESC, first_seen, symbol)")
    .where("place <= 5")
    .pick("observation_date", "symbol", "place", "total")
)
#: Articles by window and kind as one line of text.
KIND_HISTOGRAM = NEWS_WINDOWS.group(["observation_date", "kind"], n="count(*)").group(["observation_date"], kinds=listed("kind || '=' || CAST(n AS STRING)", "kind"))

"""Handoff records: required fields, ranges and links of news, breadth and option rows."""

from __future__ import annotations

from panelforge.functions import expr as x
from panelforge.plans.recipe import Recipe, sha256

#: Required fields of the record types.
REQUIRED = {
    "breadth": ("metric", "universe", "value", "numerator", "denominator", "source", "vendor", "timestamp", "observation_date"),
    "events": ("event_id", "event_date", "event_type", "title", "impact", "source", "vendor"),
    "options": ("contract_symbol", "underlying_symbol", "expiration_date", "strike_price", "option_type", "trade_date"),
    "news": ("article_id", "source", "published_at", "category"),
}
#: Texts that hint at a secret in a link or text.
SECRETS = "(api[_-]?key|secret|password|token=|bearer )"


def missing(kind: str, present: list[str]) -> dict[str, str]:
    """A rule for each required field; a column that is not there at all always fails."""
    return {f"missing_{f}": f"{f} IS NULL OR trim(CAST({f} AS STRING)) = ''" if f in present else "true" for f in REQUIRED[kind]}


NEWS = (
    Recipe()
    .add(
        reasons=x.reasons(
            **missing("news", ["article_id", "source", "published_at", "category"]),
            unsafe_url=x.both("url IS NOT NULL AND NOT ({m})", m=x.matches("url", "^https?://")),
            secret=x.matches("lower(url)", SECRETS),
            relevance_range="relevance_score < 0 OR relevance_score > 1",
            sentiment_range="sentiment_score < -1 OR sentiment_score > 1",
            score_or_label="sentiment_score IS NULL AND sentiment_label IS NULL",
        ),
        warnings=x.reasons(collected_before_published="collected_at < published_at"),
        published=("date_format(published_at, \"yyyy-MM-dd'T'HH:mm:ss\") || '+00:00'", "strftime(published_at, '%Y-%m-%dT%H:%M:%S') || '+00:00'"),
    )
    # the parts of the key: vendor, dataset, article, link, time of publication
    .add(news_id=sha256("'vendor'", "source", "article_id", "url", "published", nul=True))
    .add(accepted="reasons = ''")
)
NEWS_COLUMNS = ["article_id", "source", "reasons", "warnings", "news_id", "accepted"]
#: Daily breadth rows as handoff records: renamed counts, filled total, key.
BREADTH = (
    Recipe()
    .pick("trade_date", advancing_count="advancers", declining_count="decliners", unchanged_count="unchanged", observed_count="CASE WHEN day(trade_date) % 4 = 0 THEN NULL WHEN day(trade_date) % 9 = 0 THEN observed + 1 ELSE observed END", advancing_volume="advancing_volume")
    .add(filled="coalesce(observed_count, advancing_count + declining_count + unchanged_count)")
    .add(
        reasons=x.reasons(negative_count="least(advancing_count, declining_count, unchanged_count) < 0", observed_mismatch="filled <> advancing_count + declining_count + unchanged_count"),
        file_sha256=sha256("'day_aggs'", "trade_date"),
    )
    # vendor, dataset, file, day, universe, schema: a corrected count keeps its record's key
    .add(handoff_key=sha256("'vendor'", "'breadth_daily'", "file_sha256", "trade_date", "'US'", "'v1'", nul=True))
)

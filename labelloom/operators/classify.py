"""Filters and projections of the three logs."""

from pyspark.sql import DataFrame

from labelloom import dims
from labelloom.functions.text import lookup, null_text, quoted, quoted_list


def _order_columns(df: DataFrame) -> list[str]:
    """The ordering columns, and event_time when the rows come from a stream with a watermark."""
    return [c for c in ("ts_ms", "event_id", "event_time") if c in df.columns]


def click_actions(clicks: DataFrame, names: dict[str, str] = dims.BIZ_OF_MODEL) -> DataFrame:
    """``uid, biz`` of every click; a business outside the dictionary stays as NULL."""
    return clicks.selectExpr("uid", f"{lookup(names, 'biz_type')} AS biz", *_order_columns(clicks))


def search_actions(searches: DataFrame) -> DataFrame:
    """``uid, biz`` of every search; search logs carry the short name already."""
    return searches.selectExpr("search_mob AS uid", "biz_type AS biz", *_order_columns(searches))


def both_channels(clicks: DataFrame, searches: DataFrame, names: dict[str, str] = dims.BIZ_OF_MODEL) -> DataFrame:
    """Clicks and searches of a user side by side, told apart by ``channel``. No pairs are formed."""
    left = click_actions(clicks, names).selectExpr("*", f"{quoted(dims.CLICK_CHANNEL)} AS channel")
    right = search_actions(searches).selectExpr("*", f"{quoted(dims.SEARCH_CHANNEL)} AS channel")
    return left.unionByName(right)


_CARD = f"biz_type = {quoted(dims.CARD_MODEL)} AND pb_name IN ({quoted_list(dims.BUTTON_SUFFIX)})"
_CARD_LABEL = (
    f"concat({null_text(lookup(dims.NUMBER_TYPE_OF_CODE, 'num_type'))}, {lookup(dims.BUTTON_SUFFIX, 'pb_name')})"
)
_NUMBER = f"biz_type = {quoted(dims.NUMBER_BIZ)}"
_NUMBER_LABEL = f"concat({null_text('number_type')}, {quoted(dims.SEARCH_SUFFIX)})"


def card_click_labels(clicks: DataFrame) -> DataFrame:
    """Card clicks on the two counted buttons, as ``uid, label``."""
    return clicks.where(_CARD).selectExpr("uid", f"{_CARD_LABEL} AS label", *_order_columns(clicks))


def number_search_labels(searches: DataFrame) -> DataFrame:
    """Number searches as ``uid, label``; the number type is used as logged."""
    return searches.where(_NUMBER).selectExpr("search_mob AS uid", f"{_NUMBER_LABEL} AS label", *_order_columns(searches))


def labelled_actions(clicks: DataFrame, searches: DataFrame) -> DataFrame:
    """``uid, channel, biz, label, ts_ms, event_id`` of every click and search, each log read once; ``label`` is the
    counter that a row moves, NULL for most."""
    left = clicks.selectExpr(
        "uid", f"{quoted(dims.CLICK_CHANNEL)} AS channel", f"{lookup(dims.BIZ_OF_MODEL, 'biz_type')} AS biz",
        f"CASE WHEN {_CARD} THEN {_CARD_LABEL} END AS label", "ts_ms", "event_id",
    )
    right = searches.selectExpr(
        "search_mob AS uid", f"{quoted(dims.SEARCH_CHANNEL)} AS channel", "biz_type AS biz",
        f"CASE WHEN {_NUMBER} THEN {_NUMBER_LABEL} END AS label", "ts_ms", "event_id",
    )
    return left.unionByName(right)


def exclusive_exposures(
    exposures: DataFrame, storey: str = dims.EXCLUSIVE_STOREY, names: dict[str, str] = dims.BIZ_OF_MODEL
) -> DataFrame:
    """``uid, biz`` of the exposures in the exclusive area that can enter the queue.

    Both conditions are on raw columns, so they reach a columnar scan.
    """
    kept = exposures.where(f"storey = {quoted(storey)} AND biz_type IN ({quoted_list(names)})")
    return kept.selectExpr("uid", f"{lookup(names, 'biz_type')} AS biz", *_order_columns(exposures))


def unmapped_exposures(
    exposures: DataFrame, storey: str = dims.EXCLUSIVE_STOREY, names: dict[str, str] = dims.BIZ_OF_MODEL
) -> DataFrame:
    """The exclusive exposures left out of the queue: their business is not in the dictionary."""
    kept = exposures.where(
        f"storey = {quoted(storey)} AND NOT coalesce(biz_type IN ({quoted_list(names)}), false)"
    )
    return kept.selectExpr("uid", "biz_type", *_order_columns(exposures))

"""Weighted interest scores and their normalisation."""

from pyspark.sql import DataFrame


def weighted(clicks: str, searches: str, click_w: int, search_w: int, biz_w: int) -> str:
    return f"({clicks} * {click_w}L + {searches} * {search_w}L) * {biz_w}L"


def with_softmax(df: DataFrame, raw: list[str], out: list[str], on_flat: str = "nan") -> DataFrame:
    """Replace the ``raw`` columns by ``out``: z-score (population std), then softmax.

    When all scores are equal the z-score has no value: ``on_flat='nan'`` gives NaN,
    ``'uniform'`` gives equal shares. Each step refers to the columns before it, so every
    exponential is computed once; all steps run in one codegen stage.
    """
    if on_flat not in ("nan", "uniform"):
        raise ValueError(f"on_flat must be 'nan' or 'uniform', not {on_flat!r}")
    n = len(raw)
    flat = "double('NaN')" if on_flat == "nan" else f"{1.0 / n}D"
    keep = [c for c in df.columns if c not in raw]
    exps = [f"_e{i}" for i in range(n)]
    steps = df.selectExpr(
        *keep,
        *raw,
        f"double({' + '.join(raw)}) / {n}D AS _mean",
        f"sqrt(({' + '.join(f'({c} - _mean) * ({c} - _mean)' for c in raw)}) / {n}D) AS _std",
        *[f"CASE WHEN _std > 0 THEN exp(({c} - _mean) / _std) END AS {e}" for c, e in zip(raw, exps)],
        f"{' + '.join(exps)} AS _total",
    )
    return steps.selectExpr(*keep, *[f"coalesce({e} / _total, {flat}) AS {o}" for e, o in zip(exps, out)])

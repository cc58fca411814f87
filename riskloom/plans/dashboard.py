"""A run's dashboard: one HTML page with tables and bars drawn as SVG."""

from __future__ import annotations

from html import escape


def _show(x: object) -> str:
    return "" if x is None else f"{x:.4f}" if isinstance(x, float) else escape(str(x))


def table(rows: list[dict], most: int = 30) -> str:
    if not rows:
        return "<p>No rows.</p>"
    head = "".join(f"<th>{escape(c)}</th>" for c in rows[0])
    body = "".join("<tr>" + "".join(f"<td>{_show(v)}</td>" for v in r.values()) + "</tr>" for r in rows[:most])
    return f"<table><tr>{head}</tr>{body}</table>"


def bars(rows: list[dict], name: str, value: str, most: int = 20) -> str:
    """Horizontal bars as SVG; rows without the value are left out."""
    rows = [r for r in rows if r.get(value) is not None][:most]
    top = max((abs(r[value]) for r in rows), default=0) or 1
    lines = [f'<text x="0" y="{18 * i + 13}">{escape(str(r.get(name)))}</text><rect x="180" y="{18 * i + 2}" width="{300 * abs(r[value]) / top:.1f}" height="13"/><text x="490" y="{18 * i + 13}">{_show(float(r[value]))}</text>' for i, r in enumerate(rows)]
    return f'<svg width="600" height="{18 * len(rows) + 4}">{"".join(lines)}</svg>'


def notes_on(summary: dict) -> list[str]:
    """Gaps that deserve a second look."""
    gaps = summary.get("overfit_diagnostics") or {}
    out = []
    if gaps.get("train_test_ks_gap", 0) > 0.10:
        out.append("KS falls by more than 0.10 from train to test")
    if abs(gaps.get("test_valid_ks_gap", 0)) > 0.05:
        out.append("KS differs by more than 0.05 between test and valid")
    return out or ["no warning"]


def render(summary: dict, reports: dict[str, list[dict]]) -> str:
    """Every input is optional; what is missing shows as empty."""
    cards = "".join(f"<div><b>{escape(k)}</b> {_show(summary.get(k))}</div>" for k in ("best_model", "n_total", "n_single_rules", "n_stable_rules"))
    valid = [r for r in reports.get("score_bins", []) if r.get("dataset") == "valid"]
    parts = [
        ("Run", cards), ("Risk notes", "<ul>" + "".join(f"<li>{escape(n)}</li>" for n in notes_on(summary)) + "</ul>"), ("Parts", table(reports.get("split_profile", []))),
        ("Information value", bars(reports.get("iv_table", []), "feature", "iv")), ("Score bins", table(valid) + bars(valid, "score_bin", "lift")),
        ("Leaderboard", table(reports.get("strategy_leaderboard", []))), ("Comparison", table(reports.get("final_strategy_comparison", []))),
    ]
    return "<!DOCTYPE html><meta charset='utf-8'><title>Run</title><style>td,th{padding:2px 6px;border:1px solid #ccc}svg text{font:12px sans-serif}</style>" + "".join(f"<h2>{t}</h2>{b}" for t, b in parts)

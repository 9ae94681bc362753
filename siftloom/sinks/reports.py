"""Text reports over finished, small aggregates.

Headings and labels are fixed values, as readers of the reports look for them.
"""

from datetime import datetime, timezone

from pyspark.sql import DataFrame


def _by_count(counts: dict) -> list:
    return sorted((counts or {}).items(), key=lambda item: (-item[1], item[0]))


def _table(title: str, heading: str, counts: dict, total: int) -> list[str]:
    lines = [f"## {title}", "", f"| {heading} | Count | Percentage |", "|---|---|---|"]
    for name, count in _by_count(counts):
        lines.append(f"| {name} | {count:,} | {100 * count / total if total else 0:.1f}% |")
    return lines + [""]


def _bullets(title: str, entries: dict) -> list[str]:
    return [f"## {title}", "", *[f"- {name}: {value}" for name, value in entries.items()], ""]


def markdown(summary: DataFrame, generated: datetime = None) -> str:
    """Markdown for a one-row summary record."""
    s = summary.first().asDict()
    total = s["total_samples"]
    empty = s["empty_fields"] or {}
    stamp = (generated or datetime.now(timezone.utc)).isoformat()
    return "\n".join([
        "# Dataset Statistics Report", "", f"Generated: {stamp}", "",
        *_bullets("Summary", {
            "**Total Samples**": f"{total:,}",
            "**Duplicate Percentage**": f"{s['duplicate_percentage']:.2f}%",
            "**Average Tokens**": f"{s['average_tokens']:.0f}"}),
        *_table("Samples per Dataset", "Dataset", s["samples_per_dataset"], total),
        *_table("Language Distribution", "Language", s["language_distribution"], total),
        *_bullets("Token Statistics", {
            "Min": s["min_tokens"], "Max": s["max_tokens"],
            "Average": f"{s['average_tokens']:.0f}"}),
        *_bullets("Content Length", {
            f"Avg {name.capitalize()}": f"{s[f'average_{name}_length']:.0f} chars"
            for name in ("instruction", "input", "output")}),
        *_bullets("Quality Metrics", {
            "Samples with Tests": f"{s['samples_with_tests']:,}",
            "Empty Instructions": f"{empty.get('instruction', 0):,}",
            "Empty Outputs": f"{empty.get('output', 0):,}"}),
    ])


def write_text(spark, text: str, path: str) -> None:
    """Store a report next to the corpus, through the session's own file systems."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def console_tables(outcome) -> dict[str, DataFrame]:
    """The run, rejection and export reports as small ordered tables."""
    return {
        "statistics": outcome.run_statistics,
        "languages": outcome.by_language,
        "sources": outcome.by_dataset,
        "rejections": outcome.rejections,
        "decisions": outcome.decisions,
        "duplicates": outcome.duplicates,
        "export": outcome.splits,
    }


def show(outcome) -> None:
    for title, table in console_tables(outcome).items():
        print(f"== {title.upper()} ==")
        table.show(truncate=False)

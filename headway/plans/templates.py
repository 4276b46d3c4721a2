"""Texts made from a view's rows by declared templates, without Python per row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.scalars import literal, pattern_sql
from headway.schema import FEED

Part = str | tuple[str, str]
ORDER = "_order"


@dataclass(frozen=True)
class Template:
    """One kind of pair: where ``guard`` (SQL) holds, a row of the view gives a pair.

    ``label`` is the template id of a training pair and the difficulty of a benchmark
    item; ``criteria`` is for benchmark items only.
    """

    category: str
    label: str
    view: str
    guard: str
    instruction: str
    response: Sequence[Part] = field(default_factory=list)
    criteria: str | None = None


REGISTRY: dict[str, list[Template]] = {}


def register_template(template: Template) -> Template:
    """Adds a user's template to those made from its view."""
    REGISTRY.setdefault(template.view, []).append(template)
    return template


def compose(parts: Sequence[Part]) -> str:
    """SQL for the parts of a text, put together."""
    pieces = [
        pattern_sql(part)
        if isinstance(part, str)
        else f"if({part[0]}, {pattern_sql(part[1])}, '')"
        for part in parts
    ]
    return f"concat({', '.join(pieces)})"


def _expand(view: DataFrame, templates: Sequence[Template], fields, stage: int) -> DataFrame:
    """All texts of a view in one pass over its rows.

    The view has ``feed_id``, ``provider``, and ``item``, the order of its rows within
    the feed. ``_order`` puts the texts of all views in generation order.
    """
    made = []
    for place, template in enumerate(templates):
        texts = ", ".join(f"'{name}', {sql}" for name, sql in fields(template).items())
        made.append(f"if({template.guard}, named_struct('place', {place}, {texts}), null)")
    kept = [c for c in (FEED, "provider") if c in view.columns]
    exploded = view.selectExpr(
        *kept, "string(item) as item", f"explode(array_compact(array({', '.join(made)}))) as made"
    )
    return exploded.selectExpr(
        *[f"made.{name}" for name in fields(templates[0])],
        *kept,
        f"named_struct('stage', {stage}, 'feed', {FEED}, 'item', item, 'place', made.place)"
        f" as {ORDER}",
    )


def pairs_from(view: DataFrame, templates: Sequence[Template], stage: int = 0) -> DataFrame:
    """Training pairs (``instruction, response, category, template_id, feed_id, provider``)."""
    return _expand(
        view,
        templates,
        lambda t: {
            "instruction": pattern_sql(t.instruction),
            "response": compose(t.response),
            "category": literal(t.category),
            "template_id": literal(t.label),
        },
        stage,
    )


def items_from(view: DataFrame, templates: Sequence[Template], stage: int = 0) -> DataFrame:
    """Benchmark items (``question, expected_answer, scoring_criteria, difficulty, category``)."""
    return _expand(
        view,
        templates,
        lambda t: {
            "question": pattern_sql(t.instruction),
            "expected_answer": compose(t.response),
            "scoring_criteria": pattern_sql(t.criteria),
            "difficulty": literal(t.label),
            "category": literal(t.category),
        },
        stage,
    ).drop("provider")


def dataset_wide(view: DataFrame) -> DataFrame:
    """A view over all feeds: its pairs belong to none."""
    return view.withColumn(FEED, F.lit("")).withColumn("provider", F.lit(""))

"""Typed task parameters.

A task arrives as JSON whose values are arrays of strings; only the first
element of each array is meaningful. The keys below are fixed by the task
format and must stay as they are.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

# The task JSON keys.
KEY_START_DATE = "startDate"
KEY_END_DATE = "endDate"
KEY_START_AGE = "startAge"
KEY_END_AGE = "endAge"
KEY_PROFESSIONALS = "professionals"
KEY_CITIES = "cities"
KEY_SEX = "sex"
KEY_KEYWORDS = "keywords"
KEY_CATEGORY_IDS = "categoryIds"
KEY_TARGET_PAGE_FLOW = "targetPageFlow"


def _first(value: Any) -> str | None:
    if value is None:
        return None
    if isinstance(value, (list, tuple)):
        value = value[0] if value else None
    if value is None:
        return None
    text = str(value)
    return text if text != "" else None


def _split(text: str | None) -> list[str] | None:
    if text is None:
        return None
    parts = [p.strip() for p in text.split(",")]
    parts = [p for p in parts if p != ""]
    return parts or None


@dataclass(frozen=True)
class TaskParams:
    """Conditions of one analysis task. ``None`` means "no condition"."""

    task_id: int = 0
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: list[str] | None = None
    cities: list[str] | None = None
    sex: list[str] | None = None
    keywords: list[str] | None = None
    category_ids: list[int] | None = None
    target_page_flow: list[int] | None = field(default=None)

    @classmethod
    def from_param_map(cls, task_id: int, params: dict[str, Any]) -> "TaskParams":
        get = lambda k: _first(params.get(k))
        age = lambda k: int(get(k)) if get(k) is not None else None
        cats = _split(get(KEY_CATEGORY_IDS))
        flow = _split(get(KEY_TARGET_PAGE_FLOW))
        return cls(
            task_id=int(task_id),
            start_date=get(KEY_START_DATE),
            end_date=get(KEY_END_DATE),
            start_age=age(KEY_START_AGE),
            end_age=age(KEY_END_AGE),
            professionals=_split(get(KEY_PROFESSIONALS)),
            cities=_split(get(KEY_CITIES)),
            sex=_split(get(KEY_SEX)),
            keywords=_split(get(KEY_KEYWORDS)),
            category_ids=[int(c) for c in cats] if cats else None,
            target_page_flow=[int(p) for p in flow] if flow else None,
        )

    @classmethod
    def from_json(cls, task_id: int, text: str) -> "TaskParams":
        return cls.from_param_map(task_id, json.loads(text) if text else {})

    def to_json(self) -> str:
        """Render in the task format (every value a one-element array)."""
        out: dict[str, list[str]] = {}

        def put(key: str, value: Any) -> None:
            if value is None:
                return
            if isinstance(value, list):
                value = ",".join(str(v) for v in value)
            out[key] = [str(value)]

        put(KEY_START_DATE, self.start_date)
        put(KEY_END_DATE, self.end_date)
        put(KEY_START_AGE, self.start_age)
        put(KEY_END_AGE, self.end_age)
        put(KEY_PROFESSIONALS, self.professionals)
        put(KEY_CITIES, self.cities)
        put(KEY_SEX, self.sex)
        put(KEY_KEYWORDS, self.keywords)
        put(KEY_CATEGORY_IDS, self.category_ids)
        put(KEY_TARGET_PAGE_FLOW, self.target_page_flow)
        return json.dumps(out, ensure_ascii=False)

    def num_days(self) -> int | None:
        """Days in [start_date, end_date], both inclusive; None if open."""
        if not self.start_date or not self.end_date:
            return None
        from datetime import date

        a = date.fromisoformat(self.start_date)
        b = date.fromisoformat(self.end_date)
        return max((b - a).days + 1, 0)

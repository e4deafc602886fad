"""Where a window run resumes: marks kept with the target's data.

The target's progress holds a list ``marks``, one entry per source delivered
into it: ``{"source", "target", "type", "value"}``. It is committed together
with the rows (the native manifest, or the state table of a database).
"""

from __future__ import annotations

from ..sources.scan import Watermark

MARKS = "marks"


def _same(mark: dict, source: str, target: str) -> bool:
    return (mark["source"], mark["target"]) == (source, target)


def resume_at(progress: dict, source: str, target: str) -> Watermark | None:
    """The bound up to which ``source`` has been delivered, if it ever was."""
    return next((Watermark(m["type"], m["value"]) for m in progress.get(MARKS, ())
                 if _same(m, source, target)), None)


def with_mark(progress: dict, source: str, target: str, bound: Watermark) -> dict:
    """Progress after a delivery up to ``bound``; marks of other sources stay."""
    others = [m for m in progress.get(MARKS, ()) if not _same(m, source, target)]
    return {**progress, MARKS: [*others, {"source": source, "target": target, **bound.to_json()}]}

"""Options of one delivery run and what makes them legal.

A run is a capture (which rows), a mode (how they land) and a staging (how they
move). ``LEGAL`` lists the pairs of capture and mode that neither lose nor
repeat rows, with the options each needs; everything else is refused before any
work. ``SyncSpec.problems()`` names all that is wrong, not just the first.
"""

from __future__ import annotations

from dataclasses import dataclass, field

#: (capture, mode) -> options that must be given. Pairs that are not listed are
#: refused: a window or a change set can only be sent again safely as an upsert.
LEGAL: dict[tuple[str, str], tuple[str, ...]] = {
    ("none", "truncate"): (),
    ("none", "append"): (),
    ("none", "upsert"): ("keys",),
    ("hwm", "upsert"): ("keys", "hwm_col"),
    ("stream", "upsert"): ("keys", "change_log", "outbox"),
}
CAPTURES = tuple(dict.fromkeys(c for c, _ in LEGAL))
MODES = tuple(dict.fromkeys(m for _, m in LEGAL))
#: staging -> options that only it understands
STAGINGS: dict[str, tuple[str, ...]] = {
    "direct": ("batch_rows",),
    "parquet": ("stage_path", "keep_files"),
    "csv": ("stage_path", "keep_files"),
}

# Default rows per JDBC batch and the CSV NULL sentinel token.
DEFAULT_BATCH_ROWS = 100_000
NULL_SENTINEL = "__NULL__"

_UNITS = {"DAY", "HOUR", "MINUTE", "SECOND"}
_PATH_PUNCTUATION = set("_./:@~%+=-")


def is_column_name(name: str) -> bool:
    """An ASCII identifier; ``$`` counts as a letter."""
    return name.isascii() and name.replace("$", "_").isidentifier()


def is_table_name(name: str) -> bool:
    """Up to three column-like names with dots between; a back-quoted name may
    hold anything but a back-quote."""
    parts = name_parts(name)
    return parts is not None and 1 <= len(parts) <= 3


def name_parts(name: str) -> list[str] | None:
    """The parts of a table name without quotes, or None if it is none."""
    out, rest = [], name
    while True:
        if rest.startswith("`"):
            part, quote, rest = rest[1:].partition("`")
            if not quote or not part:
                return None
        else:
            part, dot, rest = rest.partition(".")
            rest = dot + rest
            if not is_column_name(part):
                return None
        out.append(part)
        if not rest:
            return out
        if not rest.startswith("."):
            return None
        rest = rest[1:]


def is_interval(text: str) -> bool:
    """``INTERVAL <whole number> <unit>``, as in ``INTERVAL 2 DAYS``."""
    words = text.upper().split()
    return (len(words) == 3 and words[0] == "INTERVAL" and words[1].isdecimal()
            and words[2].removesuffix("S") in _UNITS)


def is_path(text: str) -> bool:
    """A path or URI without quotes, spaces or semicolons."""
    return bool(text) and all(c.isascii() and c.isalnum() or c in _PATH_PUNCTUATION for c in text)


@dataclass
class SyncSpec:
    """What one run is asked to do.

    ``source`` and ``target`` are table or view names; ``keys`` identify rows
    in the target. ``order_cols`` order the changes of one key within a consume
    (a commit number, say); without them the times of the log's commits do.
    """

    source: str
    target: str
    capture: str = "none"
    mode: str = "truncate"
    keys: list[str] = field(default_factory=list)
    lower_cols: bool = False
    hwm_col: str | None = None
    hwm_start: object | None = None
    lookback: str | None = None          # widens the lower bound of a window
    change_log: str | None = None        # path of the append-only change log
    outbox: str | None = None            # path of the outbox
    order_cols: list[str] = field(default_factory=list)
    outbox_retention_days: int = 0
    staging: str = "direct"
    stage_path: str | None = None
    keep_files: bool = False
    batch_rows: int | None = None
    on_match: str = "update"             # update (keep target-only columns) | replace
    case_insensitive_keys: bool = False  # text keys match whatever their case (what many databases do)
    nan_to_null: bool = False            # store float NaN as NULL (what a database keeps)

    def problems(self) -> list[str]:
        """Everything that speaks against running this, in no particular order."""
        checks = [(n, v, is_table_name) for n, v in (("source", self.source), ("target", self.target))]
        checks += [("hwm_col", self.hwm_col, is_column_name), ("lookback", self.lookback, is_interval),
                   ("stage_path", self.stage_path, is_path)]
        checks += [(n, c, is_column_name) for n, cs in (("keys", self.keys), ("order_cols", self.order_cols)) for c in cs]
        out = [f"{n}: {v!r} is malformed" for n, v, good in checks if v is not None and not good(v)]
        out += [f"{n}: {v!r} is not one of {', '.join(known)}" for n, v, known in (
            ("capture", self.capture, CAPTURES), ("mode", self.mode, MODES), ("staging", self.staging, STAGINGS),
            ("on_match", self.on_match, ("update", "replace"))) if v not in known]
        if self.capture in CAPTURES and self.mode in MODES:
            needs = LEGAL.get((self.capture, self.mode))
            if needs is None:
                fits = [m for c, m in LEGAL if c == self.capture]
                out.append(f"mode: capture {self.capture} can only be delivered by {' or '.join(fits)}")
            out += [f"{n}: needed for capture {self.capture} with mode {self.mode}"
                    for n in needs or () if not getattr(self, n)]
        if self.staging in STAGINGS:
            foreign = {o for options in STAGINGS.values() for o in options} - set(STAGINGS[self.staging])
            out += [f"{o}: staging {self.staging} has no use for it" for o in sorted(foreign) if getattr(self, o)]
        if self.case_insensitive_keys and not self.keys:
            out.append("case_insensitive_keys: there are no keys")
        if self.outbox_retention_days < 0:
            out.append("outbox_retention_days: cannot be negative")
        return out

    def validate(self) -> str | None:
        return "; ".join(self.problems()) or None

    def checked(self) -> "SyncSpec":
        """This spec, with defaults filled in; raises if it is not legal."""
        if found := self.validate():
            raise ValueError(found)
        if self.staging == "direct":
            self.batch_rows = self.batch_rows or DEFAULT_BATCH_ROWS
        return self

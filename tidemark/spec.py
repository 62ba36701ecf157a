"""What to capture: coordinates, table rules, output; checked when made."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields
from pathlib import Path

from tidemark.schema import FIRST_POSITION


class SpecError(ValueError):
    """A setting that can't be used."""


def file_number(name: str) -> int | None:
    """The integer after the last dot of a log file's name; None if there is none."""
    tail = name.rpartition(".")[2] if "." in name else ""
    return int(tail) if tail.isascii() and tail.isdigit() else None


@dataclass(frozen=True)
class Pattern:
    """``schema.table``, ``*.table`` or ``schema.*``; a star is held as None."""

    schema: str | None
    table: str | None

    @staticmethod
    def parse(text: str) -> Pattern:
        parts = text.split(".")
        if len(parts) != 2 or not all(parts):
            raise SpecError(f"{text!r} is not schema.table")
        if any("*" in p and p != "*" for p in parts):
            raise SpecError(f"{text!r}: a star stands for a whole part")
        schema, table = (None if p == "*" else p for p in parts)
        if schema is None and table is None:
            raise SpecError("*.* selects everything; give no pattern instead")
        return Pattern(schema, table)

    @property
    def level(self) -> int:
        """0 for a table, 1 for a table of any schema, 2 for a schema."""
        return 0 if self.schema and self.table else 1 if self.table else 2

    def fits(self, schema: str, table: str) -> bool:
        return self.schema in (None, schema) and self.table in (None, table)


@dataclass(frozen=True)
class TableRules:
    """Include and exclude patterns; the most specific level that fits decides, include before exclude."""

    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        object.__setattr__(self, "include", tuple(self.include))
        object.__setattr__(self, "exclude", tuple(self.exclude))
        both = {Pattern.parse(p) for p in self.include} & {Pattern.parse(p) for p in self.exclude}
        if both:
            raise SpecError(f"included and excluded at once: {sorted(map(str, both))}")

    def levels(self) -> list[tuple[list[Pattern], bool]]:
        """(patterns, verdict) in the order in which they are asked."""
        sides = ((self.include, True), (self.exclude, False))
        return [([p for p in map(Pattern.parse, texts) if p.level == level], says) for level in range(3) for texts, says in sides]

    @property
    def otherwise(self) -> bool:
        """With something included, what no pattern fits is left out."""
        return not self.include

    def admits(self, schema: str, table: str) -> bool:
        return next((says for patterns, says in self.levels() if any(p.fits(schema, table) for p in patterns)), self.otherwise)


@dataclass(frozen=True)
class CaptureSpec:
    """A capture's settings, as read from a JSON file."""

    host: str = "localhost"
    port: int = 3306
    user: str = ""
    password: str = field(default="", repr=False)
    database: str = ""
    from_binlog_file: str = ""
    from_binlog_position: int = FIRST_POSITION
    to_binlog_file: str | None = None
    to_binlog_position: int | None = None
    output_mode: str = "stdout"
    parquet_output_dir: str = "./parquet_output"
    parquet_batch_size: int = 8192
    pipeline_queue_capacity: int = 32
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    ssl: bool = True
    log_level: str = "info"
    log_file: str | None = None

    def __post_init__(self) -> None:
        for name in ("include", "exclude"):
            object.__setattr__(self, name, tuple(getattr(self, name) or ()))
        if not self.host:
            raise SpecError("host is empty")
        if not 0 < self.port < 65536:
            raise SpecError("port is out of range")
        if not self.from_binlog_file:
            raise SpecError("from_binlog_file is empty")
        if self.from_binlog_position < FIRST_POSITION:
            raise SpecError(f"from_binlog_position is below {FIRST_POSITION}")
        if self.output_mode not in ("stdout", "parquet"):
            raise SpecError("output_mode is stdout or parquet")
        if self.parquet_batch_size < 1 or self.pipeline_queue_capacity < 1:
            raise SpecError("batch size and queue capacity are at least 1")
        self._check_stop()
        _ = self.rules

    def _check_stop(self) -> None:
        file, position = self.to_binlog_file, self.to_binlog_position
        if file is not None and file != self.from_binlog_file:
            first, last = file_number(self.from_binlog_file), file_number(file)
            if first is None or last is None:
                raise SpecError("log files have no number to order them by")
            if last <= first:
                raise SpecError("to_binlog_file comes before from_binlog_file")
        elif position is not None and position <= self.from_binlog_position:
            raise SpecError("to_binlog_position is not after from_binlog_position")

    @property
    def rules(self) -> TableRules:
        return TableRules(self.include, self.exclude)

    @staticmethod
    def load(path: str | Path, **over: object) -> CaptureSpec:
        """From a JSON file; unknown settings are ignored, ``over`` goes before the file."""
        known = {f.name for f in fields(CaptureSpec)}
        given = json.loads(Path(path).read_text()) | {k: v for k, v in over.items() if v is not None}
        return CaptureSpec(**{k: v for k, v in given.items() if k in known})

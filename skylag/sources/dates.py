"""Date specifications ``Y/M/D``; a blank part means any."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Years of the track archive.
ARCHIVE_YEARS = (2000, 2005)


@dataclass(frozen=True)
class DateSpec:
    year: int | None = None
    month: int | None = None
    day: int | None = None

    @classmethod
    def parse(cls, text: str, years=ARCHIVE_YEARS) -> "DateSpec":
        parts = text.strip().split("/")
        if len(parts) != 3:
            raise ValueError(f"date must have the form Y/M/D: {text!r}")
        bounds = {"year": years, "month": (1, 12), "day": (1, 31)}
        values = {}
        for (name, (low, high)), part in zip(bounds.items(), parts):
            values[name] = int(part) if part else None
            if part and not low <= values[name] <= high:
                raise ValueError(f"{name} out of bounds ({low} to {high}): {text!r}")
        return cls(**values)

    def glob(self, root: str) -> str:
        """Path pattern in an archive laid out as root/YYYY/YYYYMMm/tsmftYYYYMMDD.bz2.

        Pruning happens on names, so files of other days are never opened.
        """
        y = "*" if self.year is None else f"{self.year:04d}"
        m = "*" if self.month is None else f"{self.month:02d}"
        month_dir = "*" if self.month is None else f"{y}{m}m"
        date = "*" if self.year is None and self.month is None else f"{y}{m}"
        day_file = "*" if self.day is None else f"tsmft{date}{self.day:02d}.bz2"
        return "/".join([root.rstrip("/"), y, month_dir, day_file])

    def predicate(self) -> Column:
        """The same choice on the columns year, month, day. On a table partitioned
        by them it prunes partitions."""
        chosen = {"year": self.year, "month": self.month, "day": self.day}
        tests = [F.col(c) == v for c, v in chosen.items() if v is not None]
        return reduce(lambda a, b: a & b, tests, F.lit(True))

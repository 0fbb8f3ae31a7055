"""Dates written as day/month/year."""

import datetime as dt


_DMY = r"(?s)^(?:([0-9]{2})/([0-9]{2})/([0-9]{4}).*|.*)$"


def parse_dmy(text: str) -> str:
    """Date of a ``dd/MM/yyyy`` text (a time after it is ignored); anything else → NULL.

    The parts are put in ISO order and cast: unlike a pattern parser, the cast raises nothing inside for junk.
    """
    return f"try_cast(regexp_replace({text}, r'{_DMY}', '$3-$2-$1') AS DATE)"


def run_stamp(day: dt.date) -> str:
    """Run date as it stands in output names: ``ddmmyyyy``."""
    return day.strftime("%d%m%Y")

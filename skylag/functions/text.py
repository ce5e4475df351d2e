"""Number and text formats of the report and of marker comments.

The functions take and give SQL text, because the formats nest deeply.
"""


def two_decimals(x: str) -> str:
    """Two-decimal text, rounded from the binary value, half to even.

    ``format_string('%.2f')`` rounds the decimal text of the value instead.
    """
    return f"CASE WHEN isnan({x}) THEN 'nan' ELSE format_number({x}, '0.00') END"


def short_number(x: str) -> str:
    """A double as text with at most 12 significant digits: 4.75, 10.0, 0.808333333333."""
    steps = " ".join(
        f"WHEN abs({x}) >= {10.0 ** k!r}D THEN round({x}, {11 - k})" for k in range(6, -3, -1)
    )
    return f"cast(CASE {steps} ELSE round({x}, 14) END AS string)"


# The sample date without zero padding: 2004-5-1.
FLIGHT_DATE = "concat(year, '-', month, '-', day)"


def marker_comment(first_eta: str, first_arpt: str, time: str) -> str:
    """Comment of a marker; lines end in the two characters backslash and n."""
    lines = {
        "Flight ID": "flight_id",
        "Date": FLIGHT_DATE,
        "Departed Time": short_number("dep_time"),
        "ETA": short_number(first_eta),
        "Airport": first_arpt,
        "Time": short_number(time),
    }
    return "concat(" + ", ".join(f"'{name}: ', {text}, r'\\n'" for name, text in lines.items()) + ")"

"""JDK date patterns as Catalyst expressions: formatting with every letter, and lenient parsing.

A pattern known when the plan is built is split into runs of one letter and literal text. Formatting hands the runs
that Spark's formatter reads in the same way to one `date_format` call and builds the others itself: Spark refuses
the week letters `u`, `w`, `W`, `Y`, reads `F` and `S` in another sense (a weekday count, fractions of a second), and
limits how often most letters may repeat. Weeks begin on Sunday and the week with January 1 is the first, the rule
of the week functions.

Lenient parsing pulls the numbers out with one regular expression made from the pattern and adds them up, so a field
beyond its range rolls over: month 13 is January of the next year, day 0 the last day of the month before. Text after
the pattern's end is ignored. Text that does not fit the pattern gives null. All years are of the Gregorian calendar;
the JDK's calendar has Julian dates before October 1582.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters of a date pattern, and how often Spark's formatter takes each in the same meaning.
LETTERS = "GyYMLwWDdFEuaHkKhmsSzZX"
SAME_IN_SPARK = {"G": (1, 2, 3), "y": (1, 2, 3, 4, 5, 6), "M": (1, 2, 3, 4), "d": (1, 2), "E": (1, 2, 3, 4), "a": (1,),
                 "H": (1, 2), "k": (1, 2), "K": (1, 2), "h": (1, 2), "m": (1, 2), "s": (1, 2), "S": (3,),
                 "z": (1, 2, 3, 4), "Z": (1, 2, 3), "X": (1, 2, 3)}
# English month and weekday names, which parsing accepts in full or by their first three letters.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November",
          "December")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def pattern_runs(pattern: str) -> list[tuple[str, int | str]]:
    """[(letter, count) or ('', literal text)] of a pattern; text in single quotes is literal, '' is a quote."""
    runs: list[tuple[str, int | str]] = []

    def literal(text: str) -> None:
        if runs and runs[-1][0] == "":
            runs[-1] = ("", runs[-1][1] + text)
        elif text:
            runs.append(("", text))

    for part in re.finditer(r"''|'((?:[^']|'')*)'|([A-Za-z])\2*|[^A-Za-z']+|'", pattern):
        text = part.group()
        if text == "''":
            literal("'")
        elif part.group(1) is not None:
            literal(part.group(1).replace("''", "'"))
        elif part.group(2):
            if part.group(2) not in LETTERS:
                raise ValueError(f"illegal pattern letter {part.group(2)!r} in {pattern!r}")
            runs.append((part.group(2), len(text)))
        elif text == "'":
            raise ValueError(f"unterminated quote in {pattern!r}")
        else:
            literal(text)
    return runs


def is_plain(pattern: str) -> bool:
    """Whether Spark's formatter gives the pattern's JDK result by itself."""
    return all(n in SAME_IN_SPARK.get(letter, ()) if letter else not set(n) & set("[]{}#") for letter, n in pattern_runs(pattern))


def _sunday(day: Column) -> Column:
    return F.date_sub(day, F.dayofweek(day) - 1)


def _number(letter: str, ts: Column) -> Column:
    """The number a letter stands for."""
    day = ts.cast("date")
    # the week's Saturday says which year the week counts in; week 1 has that year's January 1
    saturday = F.date_add(_sunday(day), 6)
    hour = F.hour(ts)
    return {
        "y": lambda: F.year(day), "Y": lambda: F.year(saturday),
        "M": lambda: F.month(day), "L": lambda: F.month(day),
        "w": lambda: F.floor((F.dayofyear(saturday) - 1) / 7) + 1,
        "W": lambda: F.floor((F.dayofmonth(day) + F.dayofweek(F.trunc(day, "MM")) - 2) / 7) + 1,
        "D": lambda: F.dayofyear(day), "d": lambda: F.dayofmonth(day),
        "F": lambda: F.floor((F.dayofmonth(day) - 1) / 7) + 1, "u": lambda: F.weekday(day) + 1,
        "H": lambda: hour, "k": lambda: F.pmod(hour - 1, F.lit(24)) + 1, "K": lambda: hour % 12,
        "h": lambda: F.pmod(hour - 1, F.lit(12)) + 1, "m": lambda: F.minute(ts), "s": lambda: F.second(ts),
        "S": lambda: F.pmod(F.unix_millis(ts), F.lit(1000)),
    }[letter]()


def _run(letter: str, count: int, ts: Column) -> Column:
    """One run of a letter that Spark's formatter does not take as it is."""
    if letter == "G":
        return F.date_format(ts, "G")
    if letter in "ML" and count > 2:
        return F.date_format(ts, "MMM" if count == 3 else "MMMM")
    if letter == "E":
        return F.date_format(ts, "EEEE")
    if letter in "azZ":
        return F.date_format(ts, {"a": "a", "z": "zzzz", "Z": "Z"}[letter])
    if letter == "X":
        raise ValueError("X may repeat three times at most")
    if letter in "yY" and count == 2:
        return F.format_string("%02d", F.pmod(_number(letter, ts), F.lit(100)).cast("int"))
    return F.format_string(f"%0{count}d", _number(letter, ts).cast("int"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def format_jdk(ts: Column, pattern: str) -> Column:
    """`ts` (TIMESTAMP) formatted by a JDK pattern; null for null."""
    pieces: list[Column] = []
    plain = ""                                         # pattern text for the next date_format call

    def close() -> None:
        nonlocal plain
        if plain:
            pieces.append(F.date_format(ts, plain))
        plain = ""

    for letter, n in pattern_runs(pattern):
        if letter == "":
            plain += _quoted(n)
        elif n in SAME_IN_SPARK.get(letter, ()):
            plain += letter * n
        else:
            close()
            pieces.append(_run(letter, n, ts))
    close()
    return F.concat(*pieces) if pieces else F.when(ts.isNotNull(), F.lit(""))


# ---- lenient parsing ------------------------------------------------------------------------------------------------

_NUMBERS = "yMLDdHkKhmsS"
_MOST_DIGITS = 9                                        # more do not fit any calendar


def _lenient_fields(pattern: str) -> tuple[str, list[tuple[str, int]]]:
    """A regular expression for the pattern and the (letter, count) of its groups."""
    runs, regex, fields = pattern_runs(pattern), r"^\s*", []
    for i, (letter, n) in enumerate(runs):
        number = letter != "" and letter in _NUMBERS and not (letter in "ML" and n > 2)
        if letter == "":
            regex += "".join("\\" + c if c.isascii() and not c.isalnum() else c for c in n)
            continue
        following = runs[i + 1] if i + 1 < len(runs) else ("", "")
        abuts = following[0] != "" and following[0] in _NUMBERS and not (following[0] in "ML" and following[1] > 2)
        if number:
            # a number that another follows at once has the pattern's width, any other takes all its digits
            regex += rf"[ \t]*([0-9]{{{n}}})" if abuts else r"[ \t]*(-?[0-9]+)"
        elif letter in "ML":
            regex += "(?i:(" + "|".join(f"{m}|{m[:3]}" for m in MONTHS) + "))"
        elif letter == "E":
            regex += "(?i:(" + "|".join(f"{d}|{d[:3]}" for d in WEEKDAYS) + "))"
        elif letter == "a":
            regex += "(?i:(AM|PM))"
        else:
            raise ValueError(f"lenient parsing takes no {letter!r}")
        fields.append((letter if number or letter not in "ML" else "N", n))
    return regex, fields


def parse_lenient(text: Column, pattern: str) -> Column:
    """TIMESTAMP of `text` by a JDK pattern, fields rolling over; missing fields as of 1970-01-01 00:00:00."""
    regex, fields = _lenient_fields(pattern)
    fits = text.rlike(regex)
    whole = {letter: (F.regexp_extract(text, regex, i + 1), n) for i, (letter, n) in enumerate(fields)}

    def number(letter: str, missing: int) -> Column:
        if letter not in whole:
            return F.lit(missing)
        found = whole[letter][0]
        return F.when(F.length(found) <= _MOST_DIGITS, found.try_cast("int"))

    year = number("y", 1970)
    if "y" in whole and whole["y"][1] <= 2:
        # two digits are the year from 80 years ago to 19 years ahead that ends on them
        now = F.year(F.current_timestamp())
        near = now - 80 + F.pmod(year - (now - 80), F.lit(100))
        year = F.when(F.length(whole["y"][0]) == 2, near).otherwise(year)
    month = number("M" if "M" in whole else "L", 1)
    if "N" in whole:
        month = _month_number(whole["N"][0])
    day = number("D", 1) if "D" in whole and "d" not in whole else number("d", 1)
    first = F.try_make_timestamp_ntz(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).cast("date")
    months = F.lit(0) if "D" in whole and "d" not in whole else month - 1
    in_reach = (F.abs(year) < 200_000) & (F.abs(months) < 1_000_000) & (F.abs(day) < 50_000_000)
    date = F.when(in_reach, F.date_add(F.add_months(first, months), (day - 1).cast("int")))
    noon = F.lit(0)
    if "a" in whole:
        noon = F.when(F.upper(whole["a"][0]) == "PM", 12).otherwise(0)
    if "H" in whole:
        hour = number("H", 0)
    elif "k" in whole:
        hour = F.when(number("k", 0) == 24, 0).otherwise(number("k", 0))
    elif "K" in whole:
        hour = number("K", 0) + noon
    else:
        hour = F.when(number("h", 0) == 12, 0).otherwise(number("h", 0)) + noon
    # whole days first: an interval of hours and minutes cannot overflow then
    millis = (hour.cast("bigint") * 3_600_000 + number("m", 0).cast("bigint") * 60_000
              + number("s", 0).cast("bigint") * 1000 + number("S", 0))
    day_at = F.date_add(date, F.floor(millis / 86_400_000).cast("int"))
    rest = F.pmod(millis, F.lit(86_400_000))
    wall = day_at.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (rest / 1000).cast("decimal(18,6)"))
    return F.when(fits, wall.cast("timestamp"))


def _month_number(name: Column) -> Column:
    numbers = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS) for x in (m[:3].lower(), i + 1)])
    return F.try_element_at(numbers, F.lower(F.substring(name, 1, 3)))

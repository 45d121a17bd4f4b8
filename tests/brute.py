"""The row-wise semantics in plain Python, for small inputs. Times are datetimes."""

from datetime import datetime, timedelta
from itertools import groupby

EPOCH = datetime(1970, 1, 1)


def slice_of(t, step):
    seconds = round((t - EPOCH) / timedelta(seconds=1))  # half to even, like rint
    width = int(step.total_seconds())
    return EPOCH + timedelta(seconds=int(seconds / width) * width)


def aligned(readings, start, end, step, keys=None):
    """Rows (key, slice, datetime, value) of the readings right-joined to the dense slices."""
    keys = sorted({w for w, _, _ in readings}) if keys is None else keys
    rows = []
    for key in keys:
        at = start
        while at <= end:
            own = [(t, v) for w, t, v in readings if w == key and t is not None and slice_of(t, step) == at]
            rows += [(key, at, t, v) for t, v in own] or [(key, at, None, None)]
            at += step
    return rows


def filled(rows, method="linear", anchors="paired"):
    """Rows plus the filled value. A window frame holds all peers of (slice, datetime).

    None stands for a division by zero as well. Instants must not have two different values.
    """
    last_time = datetime.max
    out = []
    for _, series in groupby(rows, key=lambda r: r[0]):
        series = list(series)

        def place(r):
            return r[1], r[2] or last_time

        for row in series:
            back = [r for r in series if place(r) <= place(row)]
            ahead = [r for r in series if place(r) >= place(row)]

            def pick(frame, column, best):
                found = [r for r in frame if r[column] is not None]
                if column == 2 and anchors == "paired":
                    found = [r for r in frame if r[3] is not None]
                return best(found, key=place)[column] if found else None

            x0, y0 = pick(back, 2, max), pick(back, 3, max)
            x1, y1 = pick(ahead, 2, min), pick(ahead, 3, min)
            value = row[3]
            if value is None and method == "forward":
                value = y0
            elif value is None and method == "backward":
                value = y1
            elif value is None and None not in (x0, y0, x1, y1) and x0 != x1:
                s = [(t - EPOCH).total_seconds() for t in (row[1], x0, x1)]
                value = (y1 - y0) / (s[2] - s[1]) * (s[0] - s[1]) + y0
            out.append((*row, value))
    return out


def summary(rows):
    """{(key, slice): (min, max, avg)} of filled rows."""
    groups = {}
    for key, at, _, _, value in rows:
        groups.setdefault((key, at), []).append(value)
    result = {}
    for group, values in groups.items():
        known = [v for v in values if v is not None]
        result[group] = (min(known), max(known), sum(known) / len(known)) if known else (None, None, None)
    return result


def gaps(readings, threshold):
    found = []
    for key in {w for w, _, _ in readings}:
        times = sorted(t for w, t, _ in readings if w == key and t is not None)
        found += [(key, b, a) for a, b in zip(times, times[1:]) if (b - a).total_seconds() > threshold]
    return sorted(found)

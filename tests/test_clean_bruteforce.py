"""clean_legs against a plain-Python rendering of the original cleaning steps
(no Spark functions, no SQL), including the repeatable flight key."""

import datetime as dt
import re
from decimal import ROUND_HALF_UP, Decimal

import numpy as np

from aerostar.plans import fixtures, flight
from aerostar.schemas import LEG_COLUMNS
from small_tables import SF_SMALL


def r2(x):
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def hours(d):
    h = re.search(r"PT(\d+)H", d) if d else None
    m = re.search(r"(\d+)M", d) if d else None
    return r2((float(h.group(1)) if h else 0.0) + (float(m.group(1)) if m else 0.0) / 60)


def clock(raw):
    try:
        ts = dt.datetime.fromisoformat(raw)
    except (TypeError, ValueError):
        return None
    return ts.astimezone(dt.timezone.utc).strftime("%I:%M %p")


def nulls_first(v):
    return (v is not None, v if v is not None else 0)


def test_clean_legs_matches_plain_python(spark):
    legs = fixtures.legs(spark, SF_SMALL)
    raw = [tuple(r) for r in legs.select(*LEG_COLUMNS).collect()]
    idx = {c: i for i, c in enumerate(LEG_COLUMNS)}
    rows = {r for r in raw if all(r[idx[c]] is not None for c in flight.CRITICAL)}  # dedupe
    cleaned = []
    for r in rows:
        g = lambda c: r[idx[c]]
        fare = g("totalFare") if g("totalFare") is not None else 0
        airline = g("segmentsAirlineName").split("||")[0] if g("segmentsAirlineName") is not None else None
        cleaned.append((
            g("legId"), g("flightDate"), g("startingAirport"), g("destinationAirport"),
            *[1 if g(c) is True else 0 for c in ("isBasicEconomy", "isRefundable", "isNonStop")],
            float(np.float32(fare)), airline, hours(g("travelDuration")),
            clock(g("segmentsDepartureTimeRaw").split("||")[0]),
            clock(g("segmentsArrivalTimeRaw").split("||")[-1]),
        ))
    cleaned.sort(key=lambda t: tuple(nulls_first(v) for v in t))
    expected = sorted(t[1:] + (i + 1,) for i, t in enumerate(cleaned))
    got = sorted(tuple(r) for r in flight.clean_legs(legs).collect())
    assert len(got) == len(expected) > 0
    assert got == expected

"""Map projections from well-known text, as a shapefile's ``.prj`` holds it."""

from __future__ import annotations

import math
import re

from tripline.functions.geo import LambertConic

_TOKEN = re.compile(r'\s*(?:([A-Za-z_]\w*)|"((?:[^"]|"")*)"|([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)'
                    r"|([\[(])|([\])])|(,))")

# Names that the text gives the projection.
CONIC = {"lambert_conformal_conic", "lambert_conformal_conic_1sp", "lambert_conformal_conic_2sp"}


def parse(text: str) -> tuple[str, list]:
    """KEYWORD[a, b, ...] as (keyword, [a, b, ...]), nested; text and numbers as they are."""
    stack: list[list] = [[]]
    at = 0
    text = text.lstrip("﻿").rstrip()
    while at < len(text):
        token = _TOKEN.match(text, at)
        if token is None:
            raise ValueError(f"no well-known text at character {at}: {text[at:at + 20]!r}")
        word, quoted, number, opened, closed, _ = token.groups()
        if word is not None:
            stack[-1].append((word.upper(), []))
        elif quoted is not None:
            stack[-1].append(quoted.replace('""', '"'))
        elif number is not None:
            stack[-1].append(float(number))
        elif opened:
            if not stack[-1] or not isinstance(stack[-1][-1], tuple):
                raise ValueError(f"a list without its keyword at character {at}")
            stack.append(stack[-1][-1][1])
        elif closed:
            if len(stack) < 2:
                raise ValueError(f"a bracket too many at character {at}")
            stack.pop()
        at = token.end()
    if len(stack) != 1 or len(stack[0]) != 1 or not isinstance(stack[0][0], tuple):
        raise ValueError("well-known text must be one closed element")
    return stack[0][0]


def _child(node: tuple[str, list], *keywords: str) -> list | None:
    return next((x[1] for x in node[1] if isinstance(x, tuple) and x[0] in keywords), None)


def _needed(node: tuple[str, list], *keywords: str) -> list:
    found = _child(node, *keywords)
    if found is None:
        raise ValueError(f"{node[0]} lacks {' or '.join(keywords)}")
    return found


def lambert_conic(text: str) -> LambertConic:
    """The conformal conic system of a PROJCS, with one or two standard parallels.

    Angles are taken from the system's own unit to degrees, and the prime meridian
    is added to the central one. A scale factor multiplies; with one parallel the
    origin is that parallel unless the text names another latitude.
    """
    top = parse(text)
    if top[0] != "PROJCS":
        raise ValueError(f"{top[0]} is no projected system (PROJCS)")
    kind = str(_needed(top, "PROJECTION")[0])
    if kind.lower() not in CONIC:
        raise ValueError(f"projection {kind} is no Lambert conformal conic")
    base = ("GEOGCS", _needed(top, "GEOGCS"))
    spheroid = _needed(("DATUM", _needed(base, "DATUM")), "SPHEROID", "ELLIPSOID")
    angle = (_child(base, "UNIT") or ["degree", math.radians(1)])[1]
    degrees = 1.0 if math.isclose(angle, math.radians(1), rel_tol=1e-12) else math.degrees(angle)
    meridian = (_child(base, "PRIMEM") or ["Greenwich", 0.0])[1]
    values = {str(x[1][0]).lower(): x[1][1] for x in top[1]
              if isinstance(x, tuple) and x[0] == "PARAMETER"}

    def value(*names: str, default: float | None = None) -> float:
        for name in names:
            if name in values:
                return values[name]
        if default is None:
            raise ValueError(f"{kind} lacks the parameter {names[0]}")
        return default

    origin = value("latitude_of_origin", "latitude_of_center", "standard_parallel_1")
    first = value("standard_parallel_1", default=origin)
    second = value("standard_parallel_2", default=first)
    return LambertConic(
        semi_major_m=float(spheroid[1]),
        inverse_flattening=float(spheroid[2]),
        unit_m=float((_child(top, "UNIT") or ["metre", 1.0])[1]),
        false_easting=value("false_easting", default=0.0),
        false_northing=value("false_northing", default=0.0),
        central_meridian=(value("central_meridian", "longitude_of_center") + meridian) * degrees,
        parallel_1=first * degrees,
        parallel_2=second * degrees,
        origin_latitude=origin * degrees,
        scale_factor=value("scale_factor", default=1.0),
    )

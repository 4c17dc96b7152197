"""Shaping functions: plain ``Column`` expressions that whole-stage codegen takes in."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

HORIZON_MIN = 120.0


def clip01(x: Column) -> Column:
    """Between 0 and 1; NULL stays NULL, which ``greatest`` and ``least`` would skip."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def anchor_norm(x: Column, worst: float, best: float) -> Column:
    """0 at ``worst``, 1 at ``best``, clipped; either may be the larger."""
    return clip01((x - F.lit(float(worst))) / F.lit(float(best - worst)))


def smoothstep(x: Column, low: float, high: float) -> Column:
    t = anchor_norm(x, low, high)
    return t * t * (F.lit(3.0) - 2.0 * t)


def saturate(c: Column, half: float, power: float = 1.0) -> Column:
    """c^p / (c^p + half^p)."""
    cp = c if power == 1 else F.pow(c, F.lit(power))
    return cp / (cp + F.lit(half**power))


def decay(minutes: Column, horizon: float = HORIZON_MIN) -> Column:
    """Linear from 1 at once to 0 at the horizon; NULL minutes have none."""
    return F.coalesce(clip01((F.lit(horizon) - minutes) / F.lit(horizon)), F.lit(0.0))


#: The city-ness scale by tier.
CITY_HALF, CITY_FROM, CITY_TO = 25_000.0, 20_000.0, 55_000.0


def cityness(pop: Column, gross: bool = False) -> Column:
    return smoothstep(pop, CITY_FROM, CITY_TO) if gross else saturate(pop, CITY_HALF)


#: The point decay's plateau, scale and power; the reach's base and bonus.
POINT_T0, POINT_SIGMA, POINT_POWER, POINT_BASE, POINT_MORE = 5.0, 25.4, 1.385, 0.6, 1.5


def point_decay(minutes: Column) -> Column:
    late = F.greatest(F.lit(0.0), minutes - F.lit(POINT_T0)) / F.lit(POINT_SIGMA)
    return F.when(minutes.isNotNull(), F.exp(-F.pow(late, F.lit(POINT_POWER))))


def point_reach(nearest_min: Column, total: Column) -> Column:
    """Reach of the nearest point, raised by how much more there is."""
    first = point_decay(nearest_min)
    more = F.greatest(F.lit(0.0), total - first)
    return first * (F.lit(POINT_BASE) + F.lit(1 - POINT_BASE) * (F.lit(1.0) - F.exp(-more / F.lit(POINT_MORE))))


def noise_anchor(db: Column) -> Column:
    return clip01((db - F.lit(55.0)) / F.lit(15.0))


def combine_opportunity(mass: Column, half: Column, quotient: Column) -> Column:
    """Geometric mean of saturated mass and saturated location quotient."""
    return F.sqrt(mass / F.nullif(mass + half, F.lit(0.0)) * (quotient / (quotient + 1)))


def intensity(density: Column, density_half: float, per_head: Column, head_half: float) -> Column:
    """Geometric mean of squared-saturated density and capped supply per head."""
    return F.sqrt(saturate(density, density_half, 2.0) * clip01(per_head / F.lit(head_half)))


def broadband_score(share_100: Column, share_1000: Column, fibre: Column) -> Column:
    return 0.5 * share_100 + 0.3 * share_1000 + 0.2 * fibre


def noisy_or(*xs: Column) -> Column:
    rest = F.lit(1.0)
    for x in xs:
        rest = rest * (F.lit(1.0) - x)
    return F.lit(1.0) - rest


def tempered_or(xs: list[Column], beta: float) -> Column:
    """1 - (1 - best) * product over the others of (1 - beta * x)."""
    best = F.greatest(*xs) if len(xs) > 1 else xs[0]
    rest = F.lit(1.0)
    for x in xs:
        rest = rest * (F.lit(1.0) - F.lit(beta) * x)
    return F.lit(1.0) - (F.lit(1.0) - best) * rest / (F.lit(1.0) - F.lit(beta) * best)


# --- preference side -----------------------------------------------------------------


def commute_sub(minutes: Column, floor: Column, target: Column, penalty: Column | float = 1.0) -> Column:
    """0 without a route or beyond the horizon, 1 at the floor, falling to 0 at the target."""
    p = penalty if isinstance(penalty, Column) else F.lit(float(penalty))
    x = clip01((target - minutes * p) / F.nullif(target - floor, F.lit(0.0)))
    return F.when(minutes.isNull() | (minutes >= HORIZON_MIN), F.lit(0.0)).otherwise(F.pow(x, F.lit(1.5)))


def commute_total(subs: list[Column]) -> Column:
    """The best mode, raised a little by each further one; none is 0."""
    return tempered_or(subs, 0.4) if subs else F.lit(0.0)


def comfort_floor(comfort: Column, floor: Column, target: Column) -> Column:
    """Where comfort starts: never below what is reachable, and below the target."""
    return F.when(floor.isNull() | (floor == float("inf")), comfort).otherwise(F.least(F.greatest(comfort, floor), target - 1))


def over_budget(is_field: Column, score: Column, minutes: Column, budget: Column, least: float = 0.05) -> Column:
    """Whether a cell is hidden. ``least`` is our choice within the known bounds."""
    return F.when(is_field, score < F.lit(least)).otherwise(F.coalesce(minutes > budget, F.lit(True)))


def budget_opportunity(target: Column, m: Column, b: Column, o: Column, penalty: float = 1.0, horizon: float = HORIZON_MIN) -> Column:
    """Opportunity within a time budget: none below M, from B at M to O at the horizon."""
    ramp = b + clip01((target - m) / F.nullif(F.lit(horizon) - m, F.lit(0.0))) * (o - b)
    return F.when(m.isNull() | (target < m * F.lit(penalty)), F.lit(0.0)).otherwise(ramp)


def proximity(minutes: Column, zero_at: Column, gamma: float = 1.0) -> Column:
    """1 up to 3 minutes, then linear to 0 at ``zero_at``."""
    x = clip01((zero_at - minutes) / (zero_at - F.lit(3.0)))
    return x if gamma == 1 else F.pow(x, F.lit(float(gamma)))


#: Speeds in km/h and minutes lost before starting.
SPEED = {"foot": 4.5, "bike": 15.0, "car": 30.0}
OVERHEAD = {"foot": 0.0, "bike": 2.5, "car": 6.0}
SWITCH_SAVES = 3.0


#: How much longer a mode that one merely can use seems; our choice within the known bounds.
CAN_PENALTY = 1.25


def mode_minutes(minutes: Column, ref: str, mode: str) -> Column:
    """The time by one mode, from the moving time by another."""
    return minutes * F.lit(SPEED[ref] / SPEED[mode]) + F.lit(OVERHEAD[mode])


def best_mode(minutes: Column, ref: str, modes: list[str], can: frozenset[str] = frozenset()) -> Column:
    """Struct (minutes, mode): on foot, unless another mode saves 3 minutes or more.

    Modes in ``can`` are compared, but not reported, at a penalty.
    """
    foot = F.struct(mode_minutes(minutes, ref, "foot").alias("seems"), mode_minutes(minutes, ref, "foot").alias("minutes"), F.lit("foot").alias("mode"))
    others = []
    for m in modes:
        if m != "foot":
            t = mode_minutes(minutes, ref, m)
            others.append(F.struct((t * (CAN_PENALTY if m in can else 1.0)).alias("seems"), t.alias("minutes"), F.lit(m).alias("mode")))
    if not others:
        return foot
    best = F.least(*others) if len(others) > 1 else others[0]
    return F.when(foot["minutes"] - best["seems"] >= SWITCH_SAVES, best).otherwise(foot)


def weighted_geometric(scores: list[tuple[Column, float]], least: float = 0.01) -> Column:
    """exp(sum w ln s / sum w); scores below ``least`` count as it (our choice)."""
    total = sum(w for _, w in scores)
    acc = F.lit(0.0)
    for s, w in scores:
        acc = acc + F.lit(float(w)) * F.log(F.greatest(s, F.lit(least)))
    return F.exp(acc / F.lit(float(total)))


def round5(x: float) -> int:
    return int(5 * math.floor(x / 5 + 0.5))


def budget_for(floor: float, slack: float, low: int = 25, high: int = 180) -> int:
    """A time budget of a floor and some slack, in steps of five."""
    return max(low, min(high, round5(floor + slack)))


def slack_for(floor: float, budget: float, low: int = 10, high: int = 150) -> float:
    return max(low, min(high, budget - floor))

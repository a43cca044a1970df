"""Deliberate plan shapes that Catalyst does not pick by itself.

* :mod:`recordlens.plans.rank` - global dense rank / row number without a
  single-task window (range partition + per-partition offsets).
* :mod:`recordlens.plans.keep_one` - keep-one-row-per-key with an explicit
  order as an algebraic ``min(struct)`` aggregate (skew-safe).
"""

"""Operators by subject; each module lists its queries and their SQL."""

from . import catalog, changes, lookups, models, readers, referrers, rules, security, star, texts, timeline

MODULES = (star, timeline, catalog, lookups, rules, referrers, texts, changes, models, security, readers)

"""All queries of the library, by subject."""

from __future__ import annotations

from reelspark.plans import alignment, clips_and_tracks, curation, files_and_stages, growth, media, models, series  # noqa: F401  they register their queries
from reelspark.plans.registry import QUERIES, SQL  # noqa: F401

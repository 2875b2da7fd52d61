"""The fixed 27-column article schema of the news-metadata feed.

All columns are nullable. ``DATE`` is kept as its 14-digit text
(``yyyyMMddHHmmss``); the calendar day and the instant are derived from it by
:func:`tallyho.functions.times.day_of_stamp` and ``stamp_instant``, because
the original reader's date pattern used week-year letters and never parsed.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the feed, as published.
FEED_COLUMNS = [
    "GKGRECORDID", "DATE", "SourceCollectionIdentifier", "SourceCommonName",
    "DocumentIdentifier", "Counts", "V2Counts", "Themes", "V2Themes",
    "Locations", "V2Locations", "Persons", "V2Persons", "Organizations",
    "V2Organizations", "V2Tone", "Dates", "GCAM", "SharingImage",
    "RelatedImages", "SocialImageEmbeds", "SocialVideoEmbeds", "Quotations",
    "AllNames", "Amounts", "TranslationInfo", "Extras",
]

RECORD_ID_INDEX = 0
DATE_INDEX = 1
ALL_NAMES_INDEX = 23
MIN_FIELDS = ALL_NAMES_INDEX + 1  # rows with fewer fields are "short"

_INT_COLUMNS = {"SourceCollectionIdentifier"}

FEED_SCHEMA = T.StructType(
    [
        T.StructField(
            name,
            T.IntegerType() if name in _INT_COLUMNS else T.StringType(),
            True,
        )
        for name in FEED_COLUMNS
    ]
)

"""The side tables of the streaming jobs."""

from __future__ import annotations

UNREADABLE = "topic string, partition int, offset bigint, timestamp timestamp, value binary, reason string"
UNUSABLE = "id string, response string, reason string"
REJECTED = "id string, violation string"
SNAPSHOT = "dim string, k string, total bigint"
COUNTS = "country string, gender string, registration_year int, total bigint"
METRICS = "messages bigint, unreadable bigint"
CHECKED = "events bigint, `null` bigint, `date` bigint, `unique` bigint"

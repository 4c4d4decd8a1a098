"""Queries of the library's own operators, by name."""

from __future__ import annotations

from captionlake.plans import audio_queries, cue_queries, run_queries, text_queries

FLAGSHIP = "q_cues"
QUERIES = {**text_queries.Q, **cue_queries.Q, **audio_queries.Q, **run_queries.Q}
ORACLE_SQL = {**text_queries.SQL, **cue_queries.SQL, **audio_queries.SQL, **run_queries.SQL}

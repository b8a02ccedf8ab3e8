"""Builders, reports and jobs composed from the operators."""

from .builders import (
    VARIANTS, build_artists, build_songplays, build_songs, build_time, build_users,
)
from .jobs import JobConfig, constraint_checks, key_checks, load_all, run_job, run_new_files, stage_all, staged
from .reports import (
    paid_plays_by_month, paid_users_by_hour, paid_users_by_month, play_detail, resolved_plays,
    session_item, song_listeners, top_artists, top_locations, user_session_history,
)
from .standing import standing_top, standing_users
from .serving import (
    build_song_session_history, build_user_artist_history, build_user_song_history,
    preprocess_events, run_serving, save_serving,
)

__all__ = [
    "VARIANTS", "JobConfig", "build_artists", "build_song_session_history", "build_songplays",
    "build_songs", "build_time", "build_user_artist_history", "build_user_song_history",
    "build_users", "constraint_checks", "key_checks", "load_all", "paid_plays_by_month", "paid_users_by_hour",
    "paid_users_by_month", "play_detail", "preprocess_events", "resolved_plays", "run_job", "run_new_files",
    "run_serving", "save_serving", "session_item", "song_listeners", "stage_all", "staged", "standing_top",
    "standing_users", "top_artists", "top_locations", "user_session_history",
]

"""Imports every plan module so that its queries register."""

from . import q_catalogue, q_chat, q_curation, q_extra, q_forecast, q_maintain, q_ml, q_sources, q_quality, q_scalars, q_weather, q_members, q_progression, q_recommend, q_series, q_text  # noqa: F401

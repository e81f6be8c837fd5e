"""Readers: message streams and replays, JSON payloads, campaign files, warehouse SQL."""

"""Readers: grid files, typed long files, web pages, calendars."""

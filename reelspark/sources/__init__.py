"""Readers and writers of the files that media stages leave: subtitles, records, shot lists, listings."""

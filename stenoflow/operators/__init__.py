"""Operators on manifests, transcripts, alignments and timelines."""

"""Readers and writers of manifests, artefacts, subtitles, documents and logs."""

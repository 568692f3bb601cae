"""Structured Streaming drivers for the ingest and tag operators.

The reference has no streaming operator; these drivers run the SAME operators
(strict TSV parse, cell melt, multi-model tagging, profile upsert) incrementally
over files arriving in a folder, with checkpointed progress so a restarted or
failed job resumes without loss or duplication.
"""

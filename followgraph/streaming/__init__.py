"""Streaming sources.  The analytics are batch jobs; this package only
offers the edge loader over a folder of arriving TSV files."""

"""Streaming form of the jobs. The source scripts are all batch; the one job
that maps naturally onto a stream is the address cleaner (a stateless
per-row projection), offered here over a file-drop folder."""

"""Readers.  All of them use explicit schemas, so no job runs to infer one."""

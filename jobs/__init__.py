"""Runnable jobs: each a function over a session, a small configuration file and a command line."""

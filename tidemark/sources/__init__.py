"""Readers and writers: landing files, bronze folders, versioned snapshots, the warehouse, the run log."""

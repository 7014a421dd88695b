"""Readers and writers. Each reader fixes its schema, so no pass over the data infers one."""

"""Readers, sinks and the bindings from driver tables to marketing relations."""

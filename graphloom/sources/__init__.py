"""Readers and writers: manifests, blobs, recorded listing pages, state tables."""

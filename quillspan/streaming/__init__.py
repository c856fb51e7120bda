"""The stateless steps over a directory that grows."""

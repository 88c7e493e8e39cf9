from evenkeel.sources.scan import SideSpec, scan

__all__ = ["SideSpec", "scan"]

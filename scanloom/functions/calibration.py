"""The rig's calibration: fixed values that results depend on."""

from dataclasses import dataclass

# Fixed values.
FX, FY, CX, CY = 848.759, 849.231, 921.002, 565.962
#: k1, k2, p1, p2, k3
DISTORTION = (-0.014979, -0.013547, -0.001997, 0.000698, 0.003842)
LIDAR_TO_CAM = (
    (0.079231956747140869, 0.99456000522703925, -0.067621690549788172),
    (-0.98716139340257103, 0.087718305377614436, 0.13348364048516903),
    (0.13868915028045117, 0.056177352237994721, 0.9887413335600036),
)
LIDAR_TO_CAM_SHIFT = (0.018336757321533628, -0.053568141733719279, -0.15964461058920226)
WIDTH, HEIGHT = 1920, 1200
#: Translation and quaternion (x, y, z, w) of the static transform between the sensor frames.
STATIC_SHIFT = (-0.032192, -0.004570, 0.166238)
STATIC_QUAT = (0.026326, 0.070258, 0.674869, 0.734114)

IDENTITY = ((1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0))
NO_SHIFT = (0.0, 0.0, 0.0)


@dataclass(frozen=True)
class Calibration:
    """Intrinsics, distortion and the LiDAR-to-camera transform; checked when made."""

    fx: float = FX
    fy: float = FY
    cx: float = CX
    cy: float = CY
    distortion: tuple = DISTORTION
    rotation: tuple = LIDAR_TO_CAM
    shift: tuple = LIDAR_TO_CAM_SHIFT
    width: int = WIDTH
    height: int = HEIGHT
    paired_intrinsics: str = ""

    def __post_init__(self) -> None:
        if self.cx >= self.width / 2:
            raise ValueError(f"cx {self.cx} lies right of the image centre: not this camera's intrinsics")

    def provenance_warning(self, loaded_file: str) -> str | None:
        """A warning if the extrinsics were made for other intrinsics than those loaded."""
        base = loaded_file.rsplit("/", 1)[-1]
        return None if not self.paired_intrinsics or self.paired_intrinsics in base else f"paired with {self.paired_intrinsics}, loaded {base}"
